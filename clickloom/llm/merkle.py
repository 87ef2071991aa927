"""Merkle manifest of a dataset: digests of rows, subtrees per group, proofs and their check.

A leaf is the SHA-256 of a row: per column ``-`` for null, else the UTF-8 byte count,
``:`` and the value. In each group the leaves stand in the order of the id, and
``ARITY`` consecutive nodes have the SHA-256 of their hexadecimal digests as parent,
until one node is left, the group's subroot. The subroots in the order of the
group (null first, bytewise) give the root by the same rule.

Every level is joined with itself: a node in slot zero of its run meets the
nodes whose index is its own plus 1, 2, ... ``ARITY - 1``, one equijoin for each
offset, and the rows of slot zero emit the parents. Proofs go down again: the
digests of a run, with the slot of the path in it, are put before the path of its parent.
A proof is checked by folding a leaf with the digests of its path.

Scale: texts are read once by the scan that digests them; from then on rows
are an id and two digests. Ids are put in order by one range exchange, also inside
a group that holds most rows. A level is an eighth of the one below, all joins
are on (group, index) and hence on unique keys. Paths are joined per run, not
per row, so eight rows share one. The number of levels is the logarithm of the
largest group; the driver learns that, the sizes and the root. Folding and proofs are
built-in functions on the joined rows; nothing runs in Python.

Nulls in hashed columns are part of the digest. Null ids come first in their
group and are not tampered with by ``lowered``. A null group is a group of its
own, an empty string another. Equal ids go by leaf; repeated rows are leaves of
their own. Texts of any length are one value. A group of one row has its leaf as subroot, and a
single group's subroot is the root; without siblings the proof is the SHA-256 of
nothing. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ROW, positions, with_row_number
from clickloom.session import stage

#: fixed values of the contract: nodes under one parent, and the columns of a leaf in order
ARITY = 8
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: every third document, by CRC-32 of its id, is tampered with in the query
TAMPERED = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<slot: bigint, digests: array<string>>>"


def leaf(values: list[Column]) -> Column:
    """SHA-256 over values with their byte counts, in lowercase hexadecimal digits."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def joined(digests: Column) -> Column:
    """SHA-256 over the hexadecimal digits of digests."""
    return F.sha2(F.array_join(digests, ""), 256)


def runs_of(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """(group, run, size, members, digest): the runs of nodes (group, index, size, member), with the digest of the parent.

    ``member`` is a struct with a ``digest``; ``members`` holds those of a run in order.
    """
    slot = F.col("index") % arity
    runs = nodes.where(slot == 0).select("group", "index", "size", F.col("member").alias("m0"))
    for k in range(1, arity):
        sibling = nodes.where(slot == k).select("group", (F.col("index") - k).alias("index"), F.col("member").alias(f"m{k}"))
        runs = runs.join(sibling, ["group", "index"], "left")
    members = F.array_compact(F.array(*(f"m{k}" for k in range(arity))))
    found = runs.select("group", F.floor(F.col("index") / arity).alias("run"), "size", members.alias("members"))
    return found.withColumn("digest", joined(F.col("members.digest")))


def _with_paths(runs: DataFrame, above: DataFrame) -> DataFrame:
    """Runs with what their parent knows, ``above`` having (group, run, top, path): the top digest and the path from the parent up."""
    return runs.join(above, ["group", "run"])


def _stepped(arity: int) -> list[Column]:
    """What the nodes of a run know, as members of the runs below them: their run's digests come before the path."""
    step = F.struct(F.col("member_index").alias("slot"), F.col("digests"))
    return [F.col("group"), (F.col("run") * arity + F.col("member_index")).alias("run"), "top", F.concat(F.array(step), "path").alias("path")]


class Tree:
    """The levels of the trees of all groups over a written table of nodes (group, index, size, member)."""

    def __init__(self, nodes: DataFrame, arity: int = ARITY):
        self.arity, self.levels, tops = arity, [], [nodes.where("size = 1").select("group", "member.digest")]
        most = nodes.agg(F.max("size")).first()[0] or 0
        while most > 1:
            runs = stage(runs_of(nodes.where("size > 1"), arity), "runs")
            self.levels.append(runs)
            most = -(-most // arity)
            parents = runs.select("group", F.col("run").alias("index"), F.ceil(F.col("size") / arity).alias("size"), F.struct("digest").alias("member"))
            tops.append(parents.where("size = 1").select("group", "member.digest"))
            nodes = parents
        #: (group, digest) of the node that is left of each group
        self.tops = stage(reduce(DataFrame.unionByName, tops), "subroots")

    def runs_with_paths(self, tops: DataFrame) -> DataFrame | None:
        """The runs of the lowest level with ``top`` and the ``path`` of their parent; ``tops`` has (group, top, path) of the subroots."""
        known = None
        for level, runs in reversed(list(enumerate(self.levels))):
            last = runs.where(f"size <= {self.arity}").join(tops, "group")  # one run, right below the subroot
            found = last if known is None else last.unionByName(_with_paths(runs.where(f"size > {self.arity}"), known))
            if level == 0:
                return found
            nodes = found.select("group", "run", "top", "path", F.col("members.digest").alias("digests"), F.posexplode("members").alias("member_index", "member"))
            known = stage(nodes.select(*_stepped(self.arity)), "paths")
        return None


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and the digests of its path give: the leaf takes its slot in each run, from the leaves up."""

    def put(below: Column, step: Column) -> Column:
        before, after = F.slice(step["digests"], 1, step["slot"].cast("int")), F.slice(step["digests"], step["slot"].cast("int") + 2, F.lit(1 << 30))
        return joined(F.concat(before, F.array(below), after))

    return F.aggregate(path, digest, put)


def proof(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    siblings = F.flatten(F.transform(path, lambda step: F.filter(step["digests"], lambda _, k: k != step["slot"])))
    return joined(siblings)


def manifest(rows: DataFrame, order: str) -> DataFrame:
    """Subroot, root, proof and folded root of a table with (group, leaf, changed) and an id to order by.

    ``group`` is not null, and the order of the groups is that of their values. ``changed``
    is another leaf to fold the proof of the row with, or null for the same one. All columns come back.
    """
    more = [c for c in rows.columns if c not in ("group", "leaf")]
    marked = stage(with_row_number(rows), "leaves")
    by = [F.col("group"), F.col(order), F.col("leaf"), F.col(ROW)]
    sizes = marked.groupBy("group").agg(F.count("*").alias("size"))
    member = F.struct(F.col("leaf").alias("digest"), *more)
    placed = positions(marked, by, ["group"], "index").select("group", "index", member.alias("member"))
    nodes = stage(placed.join(sizes, "group"), "nodes")
    tree = Tree(nodes)
    groups = positions(tree.tops, [F.col("group")], [], "index").select(
        F.lit("").alias("group"), "index", F.struct("digest", F.col("group").alias("name")).alias("member")
    )
    n_groups = tree.tops.count()
    over = Tree(stage(groups.withColumn("size", F.lit(n_groups).cast("long")), "group-nodes"))
    root = over.tops.first()
    root = root["digest"] if root else None  # no rows
    nothing = F.array().cast(_PATH)
    single = groups.where(F.lit(n_groups) == 1).select(F.col("member.name").alias("group"), F.col("member.digest").alias("top"), nothing.alias("path"))
    tops, upper = single, over.runs_with_paths(over.tops.select("group", F.col("digest").alias("top"), nothing.alias("path")))
    if upper is not None:
        each = upper.select("path", F.col("members.digest").alias("digests"), F.posexplode("members").alias("slot", "member"))
        step = F.struct(F.col("slot").cast("long").alias("slot"), F.col("digests"))
        tops = each.select(F.col("member.name").alias("group"), F.col("member.digest").alias("top"), F.concat(F.array(step), "path").alias("path"))
    tops = stage(tops, "group-paths")
    found = nodes.where("size = 1").join(tops, "group").select("group", "member", "top", "path")
    lowest = tree.runs_with_paths(tops)
    if lowest is not None:
        each = lowest.select("group", "top", "path", F.col("members.digest").alias("digests"), F.posexplode("members").alias("slot", "member"))
        step = F.struct(F.col("slot").cast("long").alias("slot"), F.col("digests"))
        found = found.unionByName(each.select("group", "member", "top", F.concat(F.array(step), "path").alias("path")))
    result = found.select(
        "group", F.col("member.digest").alias("leaf"), *(f"member.{c}" for c in more), F.col("top").alias("subroot"),
        F.lit(root).cast("string").alias("root"), proof(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("member.changed", "member.digest"), F.col("path")).alias("folded_root"),
    )
    return result.withColumn("verified", F.col("folded_root") == F.col("root")).select(*rows.columns, "subroot", "root", "proof_sha256", "folded_root", "verified")


def lowered(docs: DataFrame, every: int = TAMPERED) -> DataFrame:
    """(doc_id, group, leaf, changed) of documents; ``changed`` is null but where ``every`` divides the CRC-32 of the id: there A-Z of the text are lower-cased."""
    values = [docs[c] for c in LEAF_COLUMNS]
    tampered = F.crc32(docs["doc_id"].cast("string")) % every == 0
    changed = leaf([*values[:-1], F.translate(docs["text"], _UPPER, _LOWER)])
    group = F.coalesce(F.concat(F.lit("="), docs["lang"]), F.lit(""))
    return docs.select("doc_id", group.alias("group"), leaf(values).alias("leaf"), F.when(tampered, changed).alias("changed"))


def document_manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document."""
    return manifest(lowered(docs), "doc_id").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")

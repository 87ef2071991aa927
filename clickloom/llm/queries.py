"""The registered queries of this package, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import boilerplate, bpe, hilbert, langid, line_frequency, merkle, minhash, pii, resampling, revisits, simhash, tiling, token_files
from clickloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight runs of equal counts along a Hilbert curve over language, source and size."""
    return hilbert.shard_documents(table(spark, sf_dir, "documents"))


def _hilbert_sql(source: str, axes: list[str], bits: int) -> str:
    """Common table expressions that end in ``curve``: ``source`` with the number of each cell along the curve."""
    n = len(axes)
    parts = [f"t0 AS (SELECT *, {', '.join(f'{a}::BIGINT AS x{k}' for k, a in enumerate(axes))} FROM {source})"]

    def add(changes: dict[int, str]) -> None:
        new = ", ".join(f"{text} AS x{k}" for k, text in changes.items())
        parts.append(f"t{len(parts)} AS (SELECT * REPLACE ({new}) FROM t{len(parts) - 1})")

    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k in range(n):
            hit = f"(x{k} >> {level}) & 1 = 1"
            swap = f"(xor(x0, x{k}) & {low})"
            changes = {0: f"CASE WHEN {hit} THEN xor(x0, {low}) ELSE xor(x0, {swap}) END"}
            if k:
                changes[k] = f"CASE WHEN {hit} THEN x{k} ELSE xor(x{k}, {swap}) END"
            add(changes)
    for k in range(1, n):
        add({k: f"xor(x{k}, x{k - 1})"})
    turn = "0"
    for level in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN (x{n - 1} >> {level}) & 1 = 1 THEN {(1 << level) - 1} ELSE 0 END)"
    add({k: f"xor(x{k}, {turn})" for k in range(n)})
    index = "0"
    for level in range(bits - 1, -1, -1):
        for k in range(n):
            index = f"({index} * 2 + ((x{k} >> {level}) & 1))"
    last = len(parts) - 1
    return ",\n".join([*parts, f"curve AS (SELECT *, {index} AS hilbert FROM t{last})"])


ORACLE["op1_hilbert_sharding"] = f"""
WITH polynomial AS (
  SELECT list(c ORDER BY i) AS remainders FROM (
    SELECT i, list_reduce([i] || range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
base AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(coalesce(text, '')) AS h, hex(coalesce(lang, '')) AS l,
    hex(coalesce(source, '')) AS s, md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
summed AS (
  SELECT * EXCLUDE (h), xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(0, length(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT),
    lambda a, b: xor(a >> 8, remainders[1 + (xor(a, b) & 255)]))) AS text_crc32
  FROM base, polynomial),
ends AS (SELECT count(*) AS rows, min(l) FILTER (l <> '') AS l0, max(l) AS l1, min(s) FILTER (s <> '') AS s0, max(s) AS s1 FROM base),
skips AS (
  SELECT rows, list_max([k FOR k IN range(0, length(l0) + 1) IF left(l0, k) = left(l1, k)]) AS lk,
    list_max([k FOR k IN range(0, length(s0) + 1) IF left(s0, k) = left(s1, k)]) AS sk FROM ends),
coded AS (
  SELECT summed.*, rows, rpad(substr(l, lk + 1, 4), 4, '0') AS c0, rpad(substr(s, sk + 1, 4), 4, '0') AS c1, length(bin(size)) - 1 AS e
  FROM summed, skips),
classed AS (SELECT *, e * 8 + (CASE WHEN e >= 3 THEN size >> (e - 3) ELSE size << (3 - e) END) % 8 AS c2 FROM coded),
binned AS (
  SELECT *, (rank() OVER (ORDER BY c0) - 1) * 16 // rows AS b0, (rank() OVER (ORDER BY c1) - 1) * 16 // rows AS b1,
    (rank() OVER (ORDER BY c2) - 1) * 16 // rows AS b2 FROM classed),
{_hilbert_sql("binned", ["b0", "b1", "b2"], hilbert.BITS)},
placed AS (SELECT *, row_number() OVER (ORDER BY hilbert, digest, doc_id, text_crc32, size) - 1 AS position FROM curve),
cut AS (SELECT *, (position * 8 // rows)::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, position - (shard * rows + 7) // 8 AS slot, NULL::INTEGER AS grown_shard, hilbert FROM cut
"""


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded with the byte-level vocabulary for many languages and decoded again."""
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document and the verdict of the line frequency rules."""
    return line_frequency.report(table(spark, sf_dir, "documents"))


ORACLE["op3_line_frequency"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) > 2),
grams AS (SELECT r, i, w[i:i+2] AS g FROM windows),
marked AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams),
repeats AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM marked WHERE n > 1) GROUP BY r),
raw_lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
lines AS (
  SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
held AS (SELECT host, norm, count(DISTINCT text) AS docs FROM lines JOIN docs USING (r) GROUP BY host, norm),
sizes AS (SELECT host, count(DISTINCT text) AS host_docs FROM docs WHERE r IN (SELECT r FROM lines) GROUP BY host),
above AS (SELECT held.host, norm FROM held JOIN sizes ON held.host IS NOT DISTINCT FROM sizes.host WHERE docs > 20 AND docs > 0.001 * host_docs),
removed AS (SELECT r, sum(words) AS n FROM lines JOIN docs USING (r) JOIN above ON above.host IS NOT DISTINCT FROM docs.host AND above.norm = lines.norm GROUP BY r),
counts AS (
  SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(text) - len(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS n_removed_words
  FROM docs JOIN words USING (r) LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN removed USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_removed_words >= 0.5 * n_words AS kept, n_removed_words
FROM judged
"""


@query
def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which tiles cover at least 0.6 of the tokens of a benchmark item, in any order."""
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page fetched twice; the second, not-modified fetch resolved to the latest full response of its address."""
    return revisits.crawl_report(spark, table(spark, sf_dir, "pages"))


ORACLE["op5_revisit_resolution"] = r"""
WITH base AS (SELECT page_id AS id, url, md5(coalesce(html, '')) AS digest, 'day ' || (page_id // 1000) AS day FROM pages),
records AS (
  SELECT id * 2 AS record_id, url, id AS fetched_at, 'response' AS kind, '"' || digest || '"' AS tag, day, digest FROM base
  UNION ALL
  SELECT id * 2 + 1, url, id + 333333, 'revisit',
    CASE left(digest, 1) WHEN '0' THEN 'W/"changed"' WHEN '1' THEN NULL ELSE 'W/"' || digest || '"' END, day, NULL FROM base),
parts AS (
  SELECT *, regexp_replace(regexp_replace(trim(coalesce(url, '')), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM records),
split AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '') AS host,
    regexp_extract(bare, '^[^/?]*(/[^?]*)', 1) AS path,
    list_sort([p FOR p IN string_split(regexp_extract(bare, '\?(.*)$', 1), '&') IF p <> '' AND lower(split_part(p, '=', 1)) NOT IN
      ('fbclid', 'gclid', 'ref', 'utm_campaign', 'utm_content', 'utm_medium', 'utm_source', 'utm_term')]) AS params FROM parts),
addressed AS (
  SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(params) = 0 THEN '' ELSE '?' || array_to_string(params, '&') END AS address FROM split),
near AS (
  SELECT *, last_value(CASE WHEN kind = 'response' THEN {'id': record_id, 'tag': tag, 'day': day, 'digest': digest} END IGNORE NULLS) OVER (
    PARTITION BY address ORDER BY fetched_at, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM addressed),
found AS (SELECT *, s.id AS sid, s.tag AS stag, s.day AS sday, s.digest AS sdigest FROM near),
judged AS (
  SELECT *, CASE WHEN kind = 'response' THEN 'full' WHEN sid IS NULL THEN 'orphan'
    WHEN coalesce(replace(tag, 'W/', '') = stag, day = sday) THEN 'resolved' ELSE 'mismatch' END AS outcome FROM found)
SELECT record_id, address, fetched_at, kind, outcome,
  CASE outcome WHEN 'full' THEN record_id WHEN 'resolved' THEN sid END AS source_id,
  CASE WHEN outcome = 'full' THEN 'cache-control: max-age=60; content-type: text/html; etag: ' || tag || '; last-modified: ' || day
    WHEN outcome = 'resolved' THEN 'cache-control: max-age=600; content-type: text/html; etag: ' || coalesce(tag, stag) || '; last-modified: ' || day
    ELSE 'cache-control: max-age=600; content-type: text/plain; ' || CASE WHEN tag IS NULL THEN '' ELSE 'etag: ' || tag || '; ' END || 'last-modified: ' || day END AS headers,
  CASE outcome WHEN 'resolved' THEN sdigest ELSE digest END AS digest
FROM judged
"""


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document: spans of the base rules and those that boosted trees add."""
    return pii.report(spark, table(spark, sf_dir, "documents"))


@query
def op7_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and page from its text, declaration, address and host."""
    return langid.corpus_languages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


@query
def op8_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return boilerplate.main_text(table(spark, sf_dir, "pages"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as token ids in flat files, read back from them."""
    return token_files.corpus_files(spark, table(spark, sf_dir, "documents"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints of 4-word shingles differ in 4 bits or fewer."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the words of the benchmark texts."""
    return resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _crc_sql(column: str) -> str:
    """CRC-32 of the UTF-8 bytes whose hexadecimal digits are in a column; needs the table ``polynomial``."""
    return f"""xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(0, length({column}) // 2), lambda k: ('0x' || substr({column}, 2 * k + 1, 2))::BIGINT),
    lambda a, b: xor(a >> 8, remainders[1 + (xor(a, b) & 255)])))"""


_POLYNOMIAL = """polynomial AS (
  SELECT list(c ORDER BY i) AS remainders FROM (
    SELECT i, list_reduce([i] || range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op11_importance_resampling"] = rf"""
WITH {_POLYNOMIAL},
raw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
target AS (SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
each AS (SELECT r, unnest(words) AS word FROM raw),
vocabulary AS (SELECT word, hex(word) AS h FROM (SELECT word FROM each UNION SELECT word FROM target)),
hashed AS (SELECT word, {_crc_sql("h")} % 10000 AS bucket FROM vocabulary, polynomial),
s AS (SELECT bucket, count(*) AS n FROM each JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS all_s, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS all_t),
gains AS (
  SELECT b.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (all_s + 10000) / ((coalesce(s.n, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM each JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT AS h FROM raw LEFT JOIN weights USING (r)),
final AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS n FROM final)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank FROM placed
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that a changed copy of it gives."""
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE {_POLYNOMIAL},
docs AS (
  SELECT *, row_number() OVER () AS r, coalesce('=' || lang, '') AS grp,
    {" || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, hex(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
leaves AS (
  SELECT r, doc_id, grp, sha256(head || {_field_sql("text")}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_crc_sql("h")} % 3 = 0 THEN sha256(head || {_field_sql("low")}) ELSE sha256(head || {_field_sql("text")}) END AS changed
  FROM docs, polynomial),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS size FROM leaves),
nodes AS (
  SELECT 0 AS level, grp, idx, size, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, grp, idx // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE size > 1 GROUP BY level, grp, idx // 8, size),
subroots AS (SELECT grp, digest, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS size FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, idx, size, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE size > 1 GROUP BY level, idx // 8, size),
runs AS (SELECT level, grp, idx // 8 AS run, list(digest ORDER BY idx) AS digests FROM nodes WHERE size > 1 GROUP BY ALL),
top_runs AS (SELECT level, idx // 8 AS run, list(digest ORDER BY idx) AS digests FROM tops WHERE size > 1 GROUP BY ALL),
walk AS (
  SELECT r, 0 AS level, grp, idx, size, changed AS digest, '' AS siblings FROM placed
  UNION ALL
  SELECT r, walk.level + 1, walk.grp, idx // 8, (size + 7) // 8, sha256(array_to_string(digests[:idx % 8] || [digest] || digests[idx % 8 + 2:], '')),
    siblings || array_to_string(digests[:idx % 8] || digests[idx % 8 + 2:], '')
  FROM walk JOIN runs ON walk.level = runs.level AND walk.grp = runs.grp AND walk.idx // 8 = runs.run WHERE size > 1),
climb AS (
  SELECT r, 0 AS level, subroots.idx, subroots.size, walk.digest, siblings FROM walk JOIN subroots USING (grp) WHERE walk.size = 1
  UNION ALL
  SELECT r, climb.level + 1, idx // 8, (size + 7) // 8, sha256(array_to_string(digests[:idx % 8] || [digest] || digests[idx % 8 + 2:], '')),
    siblings || array_to_string(digests[:idx % 8] || digests[idx % 8 + 2:], '')
  FROM climb JOIN top_runs ON climb.level = top_runs.level AND climb.idx // 8 = top_runs.run WHERE size > 1)
SELECT doc_id, leaf, subroots.digest AS subroot, tops.digest AS root, sha256(siblings) AS proof_sha256, climb.digest AS folded_root, climb.digest = tops.digest AS verified
FROM climb JOIN placed USING (r) JOIN subroots USING (grp) JOIN tops ON tops.size = 1 WHERE climb.size = 1
"""


@query
def op13_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles have a Jaccard similarity of 0.85 or more."""
    return minhash.minhash_components(table(spark, sf_dir, "documents"))

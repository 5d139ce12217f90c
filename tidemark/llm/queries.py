"""The operators over the test tables, as checked queries, and the SQL of those that SQL can express."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark

from . import adaptive_scan, containment, cross_parsing, mixing, ownership, pattern_grammar, preferences, prefix_trie, pseudo_likelihood, seekable_frames, superminhash, two_fit, zip_warc
from .tables import Scratch, held_out, table, training_row

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the library to the executors once per application, as ``--py-files`` does."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        home = Path(tidemark.__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tidemark-')}/tidemark", "zip", home.parent, home.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def _query(run: Query) -> Query:
    @wraps(run)
    def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = checked
    return checked


@_query
def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@_query
def op2_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_scan.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query
def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ownership.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"] < 3)

    def count(kind: int):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{ownership.KINDS[k]}") for k in range(3)),
        F.sha2(ownership.listing(base).cast("binary"), 256).alias("base_sha256"),
        ownership.listing(F.col("secrets")).alias("spans"),
        F.size(F.filter("secrets", lambda s: ~s["example"])).cast("long").alias("n_live"),
        F.size(F.filter("secrets", lambda s: s["example"])).cast("long").alias("n_examples"),
    )


@_query
def op5_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_warc.archive_pages(table(spark, sf_dir, "pages")).drop("url")


@_query
def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudo_likelihood.score(docs, pseudo_likelihood.fit(docs))


@_query
def op7_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last answer."""
    turns = preferences.answers_swapped(table(spark, sf_dir, "conversations"))
    return preferences.preference_turns(turns)


@_query
def op8_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op9_pattern_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = pattern_grammar.fit(docs, labels.where(training_row()))
    scored = pattern_grammar.score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= pattern_grammar.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


@_query
def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = cross_parsing.fit(docs.where(training_row()))
    return cross_parsing.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@_query
def op12_seekable_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = Scratch(spark, "frames").keep(seekable_frames.store(table(spark, sf_dir, "documents")))
    made = seekable_frames.fill_in_middle(stored)
    told = made.withColumn("told", seekable_frames.digests("frames", "form"))
    return told.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "told.*")


@_query
def op13_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = two_fit.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


ORACLES["op7_preference_pairs"] = """
WITH last AS (
    SELECT conv_id, max(turn) AS last, arg_max(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
swapped AS (
    SELECT c.conv_id AS pair_id, CAST(c.turn AS BIGINT) AS turn, c.role, c.text,
        CASE WHEN c.role = 'assistant' AND c.turn = l.last THEN coalesce(o.answer, c.text) ELSE c.text END AS other
    FROM conversations c LEFT JOIN last l USING (conv_id) LEFT JOIN last o ON o.conv_id = xor(c.conv_id, 1)),
rows AS (
    SELECT pair_id, 'chosen' AS side, turn, role, text FROM swapped
    UNION ALL SELECT pair_id, 'rejected', turn, role, other FROM swapped),
cells AS (
    SELECT pair_id, turn,
        list_sort(list(role || chr(0) || text) FILTER (side = 'chosen')) AS c,
        list_sort(list(role || chr(0) || text) FILTER (side = 'rejected')) AS r
    FROM rows GROUP BY pair_id, turn),
parted AS (SELECT pair_id, min(turn) AS parted FROM cells WHERE c IS DISTINCT FROM r GROUP BY pair_id)
SELECT pair_id, CASE WHEN common THEN 'prompt' ELSE side END AS segment, turn, role,
    '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered,
    NOT common AND role = 'assistant' AS train
FROM (SELECT rows.*, coalesce(turn < parted, true) AS common FROM rows LEFT JOIN parted USING (pair_id))
WHERE NOT common OR side = 'chosen'
"""

ORACLES["op8_benchmark_containment"] = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
b AS (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
items AS (
    SELECT DISTINCT item_id, least(len(w), 5) AS v, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM b WHERE len(w) > 0),
sizes AS (SELECT item_id, count(*) AS q FROM items GROUP BY item_id),
widths AS (SELECT DISTINCT v FROM items),
held AS (
    SELECT DISTINCT doc_id, v, unnest(list_transform(range(1, len(w) - v + 2), lambda i: array_to_string(w[i:i + v - 1], ' '))) AS s
    FROM d, widths WHERE len(w) >= v)
SELECT doc_id, item_id, count(*) AS matched, q AS item_shingles, count(*) / q AS containment
FROM held JOIN items USING (v, s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, q HAVING count(*) * 100 >= q * 80
"""

ORACLES["op11_prefix_trie"] = """
WITH t AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
        coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c FROM t),
codes AS (  -- crc32, one bit of the id's decimal text at a time
    SELECT c, c - c % 5 AS base, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
        lambda v, x: list_reduce([xor(v, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 9 AS h FROM ids),
heads AS (SELECT codes.c, t.k, role, text FROM codes JOIN t ON t.c = codes.base AND t.k <= codes.h),
turns AS (
    SELECT c, k AS d, role, text FROM heads
    UNION ALL
    SELECT t.c, coalesce(there, 0) + t.k - h, role, text FROM t JOIN codes USING (c)
    LEFT JOIN (SELECT c, count(*) AS there FROM heads GROUP BY c) AS n ON n.c = t.c WHERE t.k > h),
keys AS (
    SELECT c, d, strlen(text) AS bytes, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY d) AS path FROM turns),
paths AS (SELECT c, d, bytes, sha256(path) AS key, coalesce(lag(sha256(path)) OVER (PARTITION BY c ORDER BY d), '') AS up FROM keys
    UNION ALL SELECT c, 0, 0, '', NULL FROM ids),
nodes AS (SELECT key, d, up, min(c) AS conv_id, count(*) AS n, any_value(bytes) AS bytes FROM paths GROUP BY key, d, up),
kids AS (SELECT up AS key, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
    SELECT p.key, count(*) FILTER (kids.key IS NULL) AS leaves, sum((nodes.n - 1) * nodes.bytes) AS saved
    FROM nodes JOIN paths AS p ON p.c = nodes.conv_id AND p.d <= nodes.d LEFT JOIN kids ON kids.key = nodes.key GROUP BY p.key),
ends AS (
    SELECT key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS members FROM (SELECT c, arg_max(key, d) AS key FROM paths GROUP BY c) AS e GROUP BY key)
SELECT nodes.conv_id, CAST(nodes.d AS BIGINT) AS depth, over.conv_id AS parent_conv_id, CAST(nodes.n AS BIGINT) AS n_convs,
    CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
    sha256(coalesce(members, '')) AS ends_sha256
FROM nodes JOIN below USING (key) LEFT JOIN kids USING (key) LEFT JOIN ends USING (key) LEFT JOIN nodes AS over ON over.key = nodes.up
"""

ORACLES["op12_seekable_frames"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS h FROM documents),
drawn AS (
    SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
            WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
parts AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
        array_to_string(u[greatest(a, b) + 1:n], '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""

"""Benchmark decontamination: a prefix-filtered set join with exact verification.

An item's text gives windows of ``window`` consecutive words (one shorter window
if it has fewer). A window is contained in a document when its words occur there
in sequence, so every one of its shingles must occur: with containment 1 the
necessary prefix of the shingles, ordered by rarity in the corpus, is the single
rarest one. Documents meet that shingle in an equality join; the length bound
(the document has room for the window) and the positional bound (the shingle
sits at the window's own offset) cut candidates, and the words are compared.

Only DataFrame functions: whole texts are split in the scan, no Python runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, membership, rows_of, staged

#: Complement of the word class, before A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once for use at many places inside lambda functions."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words in their original case; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def shingle_keys(hashes: Column, k: int) -> Column:
    """One key per position that has ``k`` words from there on."""
    return F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (k - 1), F.lit(0))),
        lambda h, i: F.xxhash64(*([h] + [F.get(hashes, i + j) for j in range(1, k)]), F.lit(k)))


def _all_keys(hashes: Column, sizes: list[int]) -> Column:
    return F.concat(*[shingle_keys(hashes, k) for k in sizes])


def item_windows(items: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Rows ``(item_id, win, w, k, off, key)``: every shingle of every window, with its offset."""
    ws = F.col("ws")
    rows = (items.select(F.col(id_col).alias("item_id"), words(ascii_lower(F.col(text_col))).alias("ws"))
            .where(F.size("ws") > 0)
            .withColumn("w", F.least(F.size("ws"), F.lit(window)))
            .select("item_id", "w", F.explode(F.transform(
                F.sequence(F.lit(1), F.size("ws") - F.col("w") + 1),
                lambda i: F.slice(ws, i, F.col("w")))).alias("ws"))
            .withColumn("k", F.least("w", F.lit(shingle))))
    hashed = rows.withColumn("h", F.transform("ws", lambda x: F.xxhash64(F.lower(x))))
    keys = F.lit(None).cast("array<bigint>")
    for k in range(1, shingle + 1):
        keys = F.when(F.col("k") == k, shingle_keys(F.col("h"), k)).otherwise(keys)
    return (hashed.select("item_id", F.concat_ws(" ", "ws").alias("win"), "w", "k", F.posexplode(keys))
            .withColumnsRenamed({"pos": "off", "col": "key"}))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3, bits: int = 1 << 18,
                  doc_id: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", uid_col: str | None = None) -> DataFrame:
    """One row per document row: ``_uid`` (``uid_col``, if given), id, ``n_words``, ``hit`` (word positions inside an
    occurrence of a window, sorted), ``items`` (their distinct ids).

    Null and empty texts have no words and no hits; an empty item table hits
    nothing; items without words are ignored; a null item id marks words but is
    not listed. Repeated document rows each get a row, repeated items change
    nothing. Only the id and text columns are read, so extra columns cannot clash.
    """
    base = rows_of(docs, uid_col, F.col(doc_id).alias("_id"), F.col(text_col).alias("_text"))
    grams = staged(item_windows(items, window, shingle, item_id, item_text), "decon-grams")
    sizes = sorted(r.k for r in grams.select("k").distinct().collect())     # at most ``shingle`` values
    hashes = F.transform(words(F.col("_text")), lambda x: F.xxhash64(F.lower(x)))

    if not sizes:
        return base.select("_uid", F.col("_id").alias(doc_id), F.size(words(F.col("_text"))).cast("bigint").alias("n_words"),
                           F.array().cast("array<int>").alias("hit"),
                           F.array().cast(f"array<{items.schema[item_id].dataType.simpleString()}>").alias("items"))

    # Rarity: how often each shingle of an item occurs in the corpus.
    is_gram = membership(grams, F.col("key"), bits)
    seen = (base.select(F.explode(let(hashes, lambda h: F.filter(_all_keys(h, sizes), is_gram))).alias("key"))
            .groupBy("key").agg(F.count("*").alias("n")))
    counts = staged(grams.select("key").distinct().join(seen, "key", "left")
                    .select("key", F.coalesce("n", F.lit(0)).alias("n")), "decon-rarity")
    prefix = staged(
        grams.join(counts, "key").groupBy("item_id", "win", "w", "k")
        .agg(F.min(F.struct("n", "key", "off")).alias("p"))
        .select("item_id", "win", "w", "k", "p.key", "p.off"), "decon-prefix")

    # Candidates: positions of prefix shingles, with the words around them.
    in_prefix = membership(prefix, F.col("key"), bits)
    reach = window - 1

    def at(ws: Column, h: Column) -> Column:
        def one(k: int) -> Column:
            return let(shingle_keys(h, k), lambda keys: F.transform(
                F.filter(F.transform(keys, lambda key, i: F.when(in_prefix(key), i)), lambda i: i.isNotNull()),
                lambda i: F.struct(
                    i.alias("pos"), F.get(keys, i).alias("key"), F.least(i, F.lit(reach)).alias("before"),
                    F.slice(ws, F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("around"))))
        return F.concat(*[one(k) for k in sizes])

    cand = staged(base.select("_uid", "_id", let(words(F.col("_text")), lambda ws: let(
        F.transform(ws, lambda x: F.xxhash64(F.lower(x))),
        lambda h: F.struct(F.size(ws).alias("n_words"), at(ws, h).alias("at")))).alias("c"))
        .select("_uid", "_id", "c.*"), "decon-cand")
    start = F.col("pos") - F.col("off")
    first = F.col("before") - F.col("off")          # of the window, inside ``around``
    text = F.translate(F.concat_ws(" ", F.slice("around", first + 1, F.col("w"))), UPPER, LOWER)
    hits = (cand.select("_uid", "n_words", F.inline("at"))
            .join(prefix, "key")
            .where((start >= 0) & (first >= 0) & (start + F.col("w") <= F.col("n_words")))
            .where(text == F.col("win"))
            .groupBy("_uid")
            .agg(F.collect_set(F.struct(start.alias("s"), F.col("w"))).alias("spans"),
                 F.collect_set("item_id").alias("items")))
    hit = F.sort_array(F.array_distinct(F.flatten(F.transform(
        "spans", lambda x: F.sequence(x["s"], x["s"] + x["w"] - 1)))))
    out = hits.select("_uid", hit.alias("hit"), "items")
    return (cand.select("_uid", "_id", F.col("n_words").cast("bigint").alias("n_words"))
            .join(out, "_uid", "left")
            .select("_uid", F.col("_id").alias(doc_id), "n_words",
                    F.coalesce("hit", F.array().cast("array<int>")).alias("hit"),
                    F.coalesce("items", F.array().cast(out.schema["items"].dataType)).alias("items")))


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The digest columns of a decontamination result."""
    ids = F.sort_array(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        doc_id, "n_words", F.size("hit").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL),
b2 AS (SELECT item_id, ws, least(len(ws), 10) AS w FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, w, array_to_string(ws[i : i + w - 1], ' ') AS g
  FROM (SELECT item_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS i FROM b2)),
sizes AS (SELECT DISTINCT w FROM win),
occ AS (SELECT doc_id, w, i, array_to_string(ws[i : i + w - 1], ' ') AS g
  FROM (SELECT doc_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS i FROM d, sizes WHERE len(ws) >= w)),
hits AS (SELECT DISTINCT o.doc_id, o.i, o.w, win.item_id FROM occ o JOIN win ON o.w = win.w AND o.g = win.g),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + w)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

"""The corpus pipeline and the registered queries on the smallest tables."""

import hashlib
import random
import re

import corpus_pipeline
import pytest
import xxhash
from pyspark.sql import functions as F

from safetylake.llm import bpe, catalog, line_dedup, quality
from safetylake.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_whole(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "tokens"]
    docs = read(spark, SF, "documents")
    total = docs.count()
    rejected = quality.classify(docs, read(spark, SF, "labels")).where("predicted = 0").count()
    kept = corpus_pipeline.quality_filter(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == total - rejected
    out = corpus_pipeline.run(spark, SF)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert 0 < len(ids) <= total - rejected and len(ids) == len(set(ids))


def test_stages_take_awkward_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "one two three four", "en", "s", 18)]
    docs = spark.createDataFrame(rows, read(spark, SF, "documents").schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() <= len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_every_query_runs_whole(spark, name):
    table = {"1": "conversations", "3": "pages", "9": "embeddings", "13": "conversations"}.get(name.split("_")[0][2:], "documents")
    out = catalog.QUERIES[name](spark, SF)
    key = "conv_id" if table == "conversations" else out.columns[0]
    want = read(spark, SF, table).agg(F.count_distinct(key)).first()[0] + (name == "op1_chat")        # which adds a conversation
    assert out.count() == want or out.select(key).distinct().count() == want


def test_row_numbers_survive_other_file_splits(spark, scratch):
    """The input is split otherwise between an operator's scan and the scan that its decisions are joined to."""
    schema = read(spark, SF, "documents").schema
    rows = [(i, "a line that many files repeat" if i % 3 else f"own{i} words{i} of{i} number{i}", "en", "s", 9) for i in range(60)]
    spark.createDataFrame(rows, schema).repartition(12, "doc_id").write.parquet(f"{scratch}/docs")
    docs = spark.read.parquet(f"{scratch}/docs")
    cost = "spark.sql.files.openCostInBytes"
    old = spark.conf.get(cost)
    try:
        spark.conf.set(cost, "128m")
        lines, near = corpus_pipeline.dedup_lines(spark, docs, SF), corpus_pipeline.dedup_documents(spark, docs, SF)
        spark.conf.set(cost, "1k")
        first = min(i for i in range(60) if i % 3)
        assert {r.doc_id for r in lines.collect() if r.text} == {first} | set(range(0, 60, 3))
        assert [r.doc_id for r in near.collect() if r.doc_id % 3] == [first]
    finally:
        spark.conf.set(cost, old)


# --- a plain version of the stages after the classifier -------------------------------------------

SIGNS = line_dedup.GAPS
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(rows):
    """Texts without the lines whose words an earlier row or line has."""
    seen, out = set(), []
    for i, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            key = " ".join(re.sub(SIGNS, " ", line.lower()).split()) or "\n" + re.sub(r"\s+", "", line)
            if key == "\n" or key not in seen:
                kept.append(line)
            seen.add(key)
        out.append((i, None if text is None else "\n".join(kept)))
    return out


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    parts = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_near(rows):
    """The first document of each group of fingerprints at three bits or fewer."""
    fps = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if bin(fps[a] ^ fps[b]).count("1") <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    return [r for k, r in enumerate(rows) if label[k] == k]


def plain_clean(rows, items):
    """Documents in which no ten words of an item stand in a row."""
    def words(t):
        return WORDS.findall((t or "").translate(LOWER))

    windows = {tuple(w[k:k + 10]) for w in map(words, items) if w for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    return [(i, t) for i, t in rows
            if not any(tuple(w[k:k + n]) in windows for w in [words(t)] for n in sizes for k in range(len(w) - n + 1))]


def test_run_equals_a_plain_version(spark, scratch):
    """All five stages with production parameters over planted repeats, copies and benchmark passages."""
    rng = random.Random(30)
    docs = read(spark, SF, "documents").where("doc_id < 60")
    items = [r.text for r in read(spark, SF, "benchmark").collect()]
    base = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.orderBy("doc_id").collect()]
    longest = sorted((r for r in base if r[1]), key=lambda r: -len(r[1]))[:6]
    base += [(1000 + k, f"{r[1]}", "en", "copy", 1) for k, r in enumerate(longest[:2])]                       # copies
    base += [(1010 + k, f"{r[1]}\n{rng.choice(items)} and more", "en", "leak", 1) for k, r in enumerate(longest[2:4])]     # leaks
    base += [(1020, None, None, None, None), (1021, "", "en", None, 0)]
    table = spark.createDataFrame(base, docs.schema).withColumn("_uid", F.concat(F.lit("mine"), "doc_id"))
    for name in ("labels", "benchmark"):
        read(spark, SF, name).write.parquet(f"{scratch}/{name}.parquet")
    table.write.parquet(f"{scratch}/documents.parquet")

    rows = sorted(((r[0], r[1]) for r in base))
    kept = {r.doc_id for r in quality.classify(table.drop("_uid"), read(spark, SF, "labels")).where("predicted = 1").collect()}
    rows = plain_lines([r for r in rows if r[0] in kept])
    got = corpus_pipeline.dedup_lines(spark, table.where(F.col("doc_id").isin(list(kept))), scratch)
    fuzzy = {r.doc_id: r.text for r in got.collect()}
    assert {i for i, t in rows if t == fuzzy[i]} >= {i for i, _ in rows if i >= 1000}        # planted lines: as the plain version
    assert all(set((fuzzy[i] or "").split("\n")) <= set((t or "").split("\n")) for i, t in rows)      # further lines may go as near copies
    rows = plain_clean(plain_near([(i, fuzzy[i]) for i, _ in rows]), items)
    out = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, scratch).collect()}
    import tokenizers

    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    want = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert out == want and len(out) < len(base) - 4
    named = corpus_pipeline.quality_filter(spark, table, scratch)
    for stage in (corpus_pipeline.quality_filter, corpus_pipeline.dedup_lines, corpus_pipeline.dedup_documents, corpus_pipeline.decontaminated):
        named = stage(spark, table, scratch)
        assert named.columns == table.columns and named.where("_uid <> concat('mine', doc_id)").count() == 0
    assert corpus_pipeline.dedup_lines(spark, table.drop("n_chars"), scratch).count() == len(base)

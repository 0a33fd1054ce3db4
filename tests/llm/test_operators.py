"""Small fixtures against brute force, and the awkward cases of every operator."""

import base64
import hashlib
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from safetylake.llm import bpe, chat, decontaminate, embeddings, line_dedup, lm, quality, simhash, toxicity, warc
from safetylake.llm.common import components, numbered_rows, staged
from safetylake.session import scratch_path, shared_dir

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = [a + b for a in ("an", "be", "cor", "del", "fi", "gro", "hen", "ist") for b in ("", "ta", "mor", "lin", "er", "osk", "ub")]
AWKWARD = [None, "", "   ", "\n\n", "a", "ÉCOLE été", "x " * 5000, "same line here again", "same line here again", "!!! ???", "\u0000   z"]


def clash(df):
    """The same rows with columns whose names operators use inside."""
    for c in ("_uid", "id", "fp", "key", "row", "t", "x", "n"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("clash"))
    return df


# --- components -----------------------------------------------------------------------------------

def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 160)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- 1: chat --------------------------------------------------------------------------------------

CONV = "conv_id bigint, turn bigint, role string, text string"


def test_chat_windows_read_back(spark):
    rng = random.Random(1)
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
            (1, 0, "user", None), (1, 1, None, "<|im_end|>\n&lt;"), (1, 1, "assistant", "é" * 3), (None, None, "user", "x")]
    for c in range(2, 8):
        for t in range(rng.randrange(1, 40)):
            rows.append((c, t, "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2], prose(rng, rng.randrange(0, 60))))
    turns = spark.createDataFrame(rows, CONV).repartition(5)
    out = chat.windows(clash(turns), budget=120, history=30)
    got = {r.conv_id: r for r in chat.report(out).collect()}
    by = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(r[0], []).append(r)
    assert got.keys() == by.keys()
    for c, own in by.items():
        all_text = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256(all_text.encode()).hexdigest()
        assert got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    # a window keeps the system turn and the budget, unless one new turn alone is larger
    for w in out.collect():
        if w.conv_id and w.conv_id > 2 and w.conv_id % 2:
            assert w.text.startswith("<|im_start|>system\n")
        assert w.n_tokens <= 120 or w.n_new == 1
    assert chat.report(chat.windows(spark.createDataFrame([], CONV))).count() == 0


# --- 2: decontamination ---------------------------------------------------------------------------

def hits(text, items, window=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    marked, found = set(), set()
    for i, item in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").translate(LOWER))
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            for b in range(len(words) - n + 1):
                if words[b:b + n] == w[a:a + n]:
                    marked.update(range(b, b + n))
                    found.add(i)
    return len(words), len(marked), found


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, n)) for i, n in enumerate((25, 14, 10, 4, 2, 1))] + [(90, None), (91, "..."), (92, "ÉTÉ é")]
    texts = list(AWKWARD) + [prose(rng, 80) for _ in range(25)]
    for i, t in items[:5]:
        texts += [prose(rng, 5) + " " + t.upper().replace(" ", ", ") + " " + prose(rng, 5), " ".join(t.split()[1:])]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.report(decontaminate.decontaminate(clash(docs(spark, texts)), clash(table))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, marked, found = hits(t, items)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items) == (n, marked, len(found)), t
        assert got[i].items_sha256 == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert got[i].contaminated == (marked > 0)
    assert decontaminate.decontaminate(docs(spark, texts), table.limit(0)).where("size(hit) > 0").count() == 0
    assert decontaminate.decontaminate(docs(spark, []), table).count() == 0


# --- 3: archives ----------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string"


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, least):
    rows = [(5, "http://a.org/x?y=1#z", "<p>é</p>"), (3, "http://b.org", "<p>é</p>"), (4, None, None), (6, "no url\r\nX: 1", ""),
            (7, "http://c.org/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (8, "u", "\n\n"), (9, "u", "x" * 100_000), (9, "u", "x" * 100_000)]
    path = scratch_path(spark, "test-warc")
    warc.write(clash(spark.createDataFrame(rows, PAGES).repartition(3)), path, min_bytes=least)
    records = staged(warc.read(spark, path), "test-records")
    assert records.count() == 3 * len(rows)
    captures = warc.assemble(records)
    assert captures.where("response IS NULL OR request IS NULL OR metadata IS NULL").count() == 0
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.report(captures).collect())
    want, seen = [], set()
    for i, _, h in sorted(rows, key=lambda r: r[0]):
        data = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "")] if len(data) >= least else [i]
        again = min(same) < i or (data, i) in seen
        if len(data) >= least:
            seen.add((data, i))
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
                     min(same) if again else None))
    assert sorted(want, key=str) == sorted(got, key=str)
    body = captures.where("response.type = 'response' AND metadata.uri = 'http://c.org/'").first().response.block
    assert bytes(body).endswith(rows[4][2].encode())


def test_warc_equal_payloads_are_found_by_the_bare_digest(spark, monkeypatch):
    """Its text, which costs far more, is only made for the records."""
    seen, real = {}, warc.staged
    monkeypatch.setattr(warc, "staged", lambda df, label: seen.update({label: df.schema}) or real(df, label))
    pages = [(i, f"http://h/{i}", "same" if i % 2 else f"own {i}") for i in range(6)]
    path = scratch_path(spark, "test-warc-digest")
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    assert seen["warc-first"]["sha"].dataType.simpleString() == "binary"
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in warc.report(warc.assemble(real(warc.read(spark, path), "test-records"))).collect()}
    assert kinds == {i: ("revisit", 1) if i in (3, 5) else ("response", None) for i in range(6)}


def test_archives_orphans_and_empty(spark):
    path = scratch_path(spark, "test-warc-empty")
    warc.write(spark.createDataFrame([], PAGES), path)
    records = warc.read(spark, path)
    assert warc.report(warc.assemble(records)).count() == 0
    lone = spark.createDataFrame([("<r>", "request", "<gone>", None, "u", "d", None, None, None, None),
                                  ("<v>", "revisit", None, "<lost>", "u", "d", "sha1:X", None, None, None)], warc.RECORD)
    got = {r.capture_id: r for r in warc.assemble(lone).collect()}
    assert got["<gone>"].response is None and got["<v>"].original is None
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 9\r\n\r\nabc"))


# --- 4: BPE ---------------------------------------------------------------------------------------

def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(bpe.default_path())
    theirs.no_truncation()
    theirs.no_padding()
    rng = random.Random(4)
    ours = bpe.load(bpe.default_path())
    texts = [t or "" for t in AWKWARD] + ["<|endoftext|>a<|startoftext|>", "ΑΣ ΟΔΟΣ", "don't 's 12", "aaaa" * 50, "é Ᲊ₞", "\x1c a\x85b"]
    texts += ["".join(rng.choice("aabcest'") for _ in range(rng.randrange(1, 14))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice((rng.randrange(32, 127), rng.randrange(0xA0, 0x250), rng.randrange(0x300, 0x2FFF)))) for _ in range(8)) for _ in range(500)]
    for t in texts:
        ids = theirs.encode(t, add_special_tokens=False).ids
        assert ours.encode(t) == np.array(ids, dtype="<u4").tobytes(), repr(t)
        assert ours.decode(ours.encode(t)) == theirs.decode(ids, skip_special_tokens=False)
    table = clash(docs(spark, AWKWARD))
    rows = {r.doc_id: r for r in bpe.round_trip(table, with_ids=True).collect()}
    for i, t in enumerate(AWKWARD):
        assert rows[i].ids == theirs.encode(t or "", add_special_tokens=False).ids and rows[i].n_tokens == len(rows[i].ids)
    back = bpe.decode(bpe.encode(table).select("row.doc_id", "ids")).collect()
    assert {r.row.doc_id: r.decoded for r in back}[5] == ours.decode(ours.encode(AWKWARD[5]))
    assert bpe.round_trip(docs(spark, [])).count() == 0


# --- 5: SimHash -----------------------------------------------------------------------------------

def simple_fingerprint(text):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("distance", [0, 1, 3, 4])
def test_simhash_links_match_all_pairs(spark, distance):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for k in range(1, 6):
            fps.add(f ^ sum({1 << rng.randrange(64) for _ in range(k)}))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    got = [(r.a, r.b) for r in simhash.links(table, distance).collect()]
    want = {tuple(sorted((signed(a), signed(b)))) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= distance}
    assert len(got) == len(set(got)) and set(got) == want


def test_simhash_components(spark):
    rng = random.Random(6)
    base = prose(rng, 300).split()
    texts = list(AWKWARD) + [" ".join(base)] * 3
    for k in range(12):
        w = list(base)
        w[rng.randrange(300)] = "changed"
        texts.append(" ".join(w))
    fps = [simple_fingerprint(t) for t in texts]
    label = list(range(len(texts)))
    for _ in label:
        for i, a in enumerate(fps):
            label[i] = min(label[j] for j, b in enumerate(fps) if bin(a ^ b).count("1") <= 3)
    rows = simhash.near_duplicates(clash(docs(spark, texts))).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(label))
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in enumerate(fps)}
    assert sum(r.kept for r in rows) == len(set(label))
    twice = simhash.near_duplicates(docs(spark, ["a b c"] * 3, ids=[None, 4, 4])).collect()
    assert [r.component_id for r in twice] == [4, 4, 4] and sum(r.kept for r in twice) == 1
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


# --- 6: quality -----------------------------------------------------------------------------------

def test_quality_separates_and_handles_awkward(spark):
    rng = random.Random(7)
    texts = [prose(rng, 60).capitalize() + "." for _ in range(150)] + ["!!! ### " * 20 + prose(rng, 3) for _ in range(150)]
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(300)] + [(2, None, None), (None, 1, 1), (7_000, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    table = docs(spark, texts + AWKWARD)
    rows = quality.classify(clash(table), labels).collect()
    assert len(rows) == len(texts) + len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 300]
    assert all(r.held_out == (quality.crc_remainder(r.doc_id) == 0) for r in rows)
    assert held and sum(r.predicted == (r.doc_id < 150) for r in held) >= 0.95 * len(held)
    assert {r.score for r in quality.classify(table, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs(spark, []), labels).count() == 0


def test_isotonic_is_monotone_and_keeps_the_mean():
    y, w = np.array([0.0, 0.4, 0.2, 0.9, 0.8]), np.array([1.0, 2, 2, 1, 3])
    fit = quality.isotonic(y, w)
    assert (np.diff(fit) >= 0).all() and math.isclose((fit * w).sum(), (y * w).sum())


# --- 7: lines -------------------------------------------------------------------------------------

def test_line_simhash_matches_bit_counts(spark):
    rng = random.Random(8)
    rows = [(i, [rng.getrandbits(64) - (1 << 63) for _ in range(n)]) for i, n in enumerate((1, 2, 15, 16, 17, 62, 63, 64, 500, 16_383, 17_000))]
    rows += [(50, [-1] * 63), (51, [-1] * 16_383), (52, [0] * 40)]
    table = spark.createDataFrame(rows, "i int, h array<bigint>")
    got = {r.i: r.fp for r in line_dedup.with_simhash(table).collect()}
    for i, h in rows:
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert got[i] % (1 << 64) == want


def test_lines_keep_one_occurrence(spark):
    rng = random.Random(9)
    lines = [prose(rng, 40) for _ in range(6)]
    near = lines[0].split()
    near[5] = near[5] + "x"
    texts = [lines[0] + "\n" + lines[1], lines[2] + "\n\n" + lines[0].upper() + "!!\n" + lines[0], " ".join(near), lines[3] + "\n" + lines[3], *AWKWARD,
             lines[4], "a b\nc d\na b"]
    rows = {r.doc_id: r for r in line_dedup.report(line_dedup.dedup_lines(clash(docs(spark, texts)), distance=8)).collect()}
    assert len(rows) == len(texts)
    assert rows[0].text == texts[0] and rows[1].text == lines[2] + "\n" and rows[1].n_dropped == 2
    assert rows[2].text == "" and rows[3].text == lines[3]
    first = 4 + AWKWARD.index("same line here again")
    assert rows[first].text == texts[first] and rows[first + 1].text == ""
    assert rows[4].text is None and rows[4].n_lines == 0 and rows[5].text == ""
    assert rows[len(texts) - 1].text == texts[-1]       # under three words: never dropped
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_line_leaders_lose_no_group(spark):
    """A dense cluster and a chain: the groups are those of all verified pairs."""
    rng = random.Random(10)
    base = prose(rng, 80).split()
    texts = []
    for k in range(30):
        w = list(base)
        for _ in range(k % 4):
            w[rng.randrange(80)] = f"v{rng.randrange(99)}"
        texts.append(" ".join(w))
    table = docs(spark, texts)
    src = table.select(F.col("doc_id").alias("_uid"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    fp = {r._id: r.fp for r in line_dedup.line_table(src, 3).collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    label = list(range(30))
    linked = [(i, j) for i in range(30) for j in range(i) if bin((fp[i] ^ fp[j]) % (1 << 64)).count("1") <= 3
              and edits(texts[i].split(), texts[j].split()) <= 16]
    for _ in range(30):
        for i, j in linked:
            label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r.text for r in line_dedup.report(line_dedup.dedup_lines(table)).collect()}
    assert {i for i, t in got.items() if t} == set(label)


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_keep_what_is_not_similar(spark):
    """Two lines of ten words with four edits; of the new words two pairs share a cheap character."""
    a = "same words here w345 w274 and one more line yes".split()
    b = "same words here w57 w304 and other much line yes".split()
    assert word_edits(a, b) == 4
    pairs = spark.createDataFrame([(a, b, 2), (a, b, 4), (a, a, 0), (["x"] * 300, ["x"] * 250, 50), (["x"] * 300, ["x"] * 250, 49)],
                                  "a array<string>, b array<string>, most int")
    pairs = pairs.select(*[F.transform(c, lambda w: F.xxhash64(w)).alias(c) for c in "ab"], "most")
    got = pairs.select(line_dedup.within(F.col("a"), F.col("b"), F.col("most")).alias("near")).collect()
    assert [r.near for r in got] == [False, True, True, True, False]
    cheap = pairs.limit(1).select((F.call_function("levenshtein", *[line_dedup.spelled(F.col(c)) for c in "ab"], F.lit(2)) >= 0).alias("x"))
    assert cheap.first().x          # by its characters alone the pair would pass
    texts = [" ".join(a), " ".join(b)]
    got = {r.doc_id: r.text for r in line_dedup.report(line_dedup.dedup_lines(docs(spark, texts), distance=8)).collect()}
    assert got == dict(enumerate(texts))


def test_line_links_are_those_of_distance_and_similarity(spark):
    """Production parameters against all pairs: every pair within the distance and the similarity, and no other."""
    rng = random.Random(20)
    lines = []
    for n in (3, 5, 8, 12, 20, 33, 60, 90, 130, 200):
        base = [f"w{rng.randrange(500)}" for _ in range(n)]
        lines.append(base)
        for k in range(6):
            w = list(base)
            for _ in range(rng.choice((1, 1, 2, n // 10, n // 5))):
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                w[at:at + (kind != 1)] = [] if kind == 2 and len(w) > 3 else [f"v{rng.randrange(500)}"]
            lines.append(w)
    lines += [["x"] * 300, ["x"] * 250, ["x"] * 230]
    table = spark.createDataFrame([(i, len(w), w) for i, w in enumerate(lines)], "i int, n int, w array<string>")
    fp = {r.i: r.fp for r in line_dedup.with_simhash(table.select("i", F.transform("w", lambda w: F.xxhash64(w)).alias("h"))).collect()}
    label = list(range(len(lines)))
    linked = [(i, j) for i, a in enumerate(lines) for j, b in enumerate(lines[:i])
              if bin((fp[i] ^ fp[j]) % (1 << 64)).count("1") <= 3
              and word_edits(a, b) <= math.floor(max(len(a), len(b)) * 0.2 + 1e-9)]
    for _ in lines:
        for i, j in linked:
            label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r.text for r in line_dedup.report(line_dedup.dedup_lines(docs(spark, [" ".join(w) for w in lines]))).collect()}
    assert len(linked) > 15 and {i for i, t in got.items() if t} == set(label)


def test_short_lines_repeat_once(spark):
    """Lines of any number of words, signs alone, and scripts without spaces are grouped exactly."""
    long = "这是一段没有空格的文字它在许多文件里重复出现"
    texts = ["page two\nx\n\n***", "Page two.\n \nX\n* **\n***", f"{long}，后面", f"“{long}” 后面", "it’s", "it's", "~~", "\u3000\n\u3000"]
    out = line_dedup.dedup_lines(docs(spark, texts), short=True)
    got = {r.doc_id: r.text for r in line_dedup.report(out).collect()}
    assert got == {0: texts[0], 1: " ", 2: texts[2], 3: "", 4: texts[4], 5: "", 6: "~~", 7: texts[7]}


def test_blocks_shared_by_chance_are_not_written(spark):
    """Fingerprints that agree on a pair of blocks and are far apart leave the search at once; close ones stay."""
    rng = random.Random(3)
    low = rng.getrandbits(20)
    fps = [(rng.getrandbits(38) << 25 | low) for _ in range(200)]
    fps += [fps[0] ^ 1 << 60, fps[1] ^ 0b101 << 40]
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp bigint, copies bigint")
    got = {r.fp for r in line_dedup.block_table(table, 3).collect()}
    assert got == {r.fp for r in table.collect() if r.copies in (0, 1, 200, 201)}


def test_crowded_fingerprints_give_few_candidates(spark):
    """Lines of one SimHash, or of close ones, whose words tell them apart are not compared word by word; similar ones still meet."""
    rng = random.Random(12)
    texts = [" ".join(["same"] * 45 + [f"w{i}v{k}" for k in range(40)]) for i in range(40)]
    assert len(set(texts)) == 40
    texts += [texts[7].replace("w7v3", "other")] + [f"{prose(rng, 30)} {i}" for i in range(3)]
    shared = shared_dir(spark)
    before = set(os.listdir(shared))
    got = {r.doc_id: r.text for r in line_dedup.report(line_dedup.dedup_lines(docs(spark, texts))).collect()}
    assert got == {i: "" if i == 40 else t for i, t in enumerate(texts)}
    seen = [x for x in set(os.listdir(shared)) - before if x.startswith("line-cand-other-")]
    assert len(seen) == 1 and spark.read.parquet(f"{shared}/{seen[0]}").count() < 40


def test_pairs_of_buckets_are_those_of_all_lines(spark):
    """Blocks, length bins and sketches lose no pair of lines that is near and similar, and give each once."""
    rng = random.Random(13)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps, lines = {}, []
    for i in range(150):
        fp = seeds[i % 6] if i >= 12 else rng.getrandbits(64)
        for _ in range(rng.randrange(3)):
            fp ^= 1 << rng.randrange(64)
        fps[fp - (1 << 64) if fp >> 63 else fp] = 1
    words = [rng.getrandbits(64) - (1 << 63) for _ in range(40)]
    for fp in fps:
        for _ in range(1 + (rng.random() < 0.2)):
            h = [w if rng.random() > 0.1 else rng.getrandbits(64) - (1 << 63) for w in words[:rng.choice((3, 4, 5, 20, 25, 31, 40))]]
            lines.append((fp, f"{len(lines):03}".encode(), h))
    groups = {fp: b"g" for k, fp in enumerate(fps) if k % 5 == 0}
    every = spark.createDataFrame(lines, "fp bigint, key binary, h array<bigint>")
    lines_df = every.select("fp", "key", F.size("h").alias("n")).join(line_dedup.sketches(every.select("key", "h")), "key")
    label = spark.createDataFrame(list(groups.items()), "fp bigint, group binary")
    for distance, similarity in ((3, 0.8), (1, 0.5), (3, 1.0)):
        table = line_dedup.block_table(spark.createDataFrame([(fp, 1) for fp in fps], "fp bigint, copies bigint"), distance)
        got = Counter((bytes(r.key_a), bytes(r.key_b)) for r in line_dedup.other_pairs(table, label, lines_df, distance, similarity).collect())
        twins = Counter((bytes(r.key_a), bytes(r.key_b)) for r in line_dedup.twin_pairs(lines_df, similarity).collect())
        assert max([*got.values(), *twins.values()]) == 1
        for i, (fp, key, h) in enumerate(lines):
            for fp2, key2, h2 in lines[i + 1:]:
                most = max(len(h), len(h2)) * (1 - similarity) + 1e-9
                apart = max(len(set(h) - set(h2)), len(set(h2) - set(h)), abs(len(h) - len(h2))) > most
                if fp == fp2:
                    assert apart or (key, key2) in twins
                elif not apart and bin((fp ^ fp2) & (1 << 64) - 1).count("1") <= distance and not (fp in groups and fp2 in groups):
                    assert ((key, key2) in got) != ((key2, key) in got)


def test_rows_of_a_stored_table_are_numbered_in_place(spark, scratch):
    """Row numbers of stored Parquet are the same however a scan is split, and nothing is written; other frames are written once."""
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("row"), F.lit("x").alias("a.b"), F.lit(1).alias("_uid")).repartition(5)
    df.write.parquet(f"{scratch}/t")
    before = set(os.listdir(shared_dir(spark)))
    rows = numbered_rows(spark.read.parquet(f"{scratch}/t"), "test-rows")
    first = {r.i: r.u for r in rows.select(F.col("row.id").alias("i"), F.col("_uid").alias("u")).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = {r.i: r.u for r in rows.where("row.id % 2 = 0").select(F.col("row.id").alias("i"), F.col("_uid").alias("u")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(first.values()) == list(range(1000)) and all(first[i] == u for i, u in again.items())
    assert set(os.listdir(shared_dir(spark))) == before
    for other in (spark.read.parquet(f"{scratch}/t", f"{scratch}/t"), spark.read.parquet(f"{scratch}/t").where("id < 9"),
                  spark.read.parquet(f"{scratch}/t").withColumn("_metadata", F.lit(1)), df, df.limit(0)):
        got = numbered_rows(other, "test-rows")
        assert got.select("_uid").distinct().count() == got.count() == other.count()
        assert got.select("row.*").columns == other.columns


@pytest.mark.parametrize("size", [1, 2, 63, 64, 126, 255, 256])
def test_adders_count_like_a_majority(spark, size):
    rng = random.Random(size)
    rows = [(i, [rng.getrandbits(64) - (1 << 63) for _ in range(size - i % 2)] or [5]) for i in range(4)]
    table = spark.createDataFrame(rows, "i int, h array<bigint>")
    got = {r.i: r.fp for r in line_dedup.with_simhash(table).collect()}
    for i, h in rows:
        want = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))
        assert got[i] == (want - (1 << 64) if want >> 63 else want)


def test_lines_that_differ_in_places_need_no_edit_distance(spark):
    """A line of one word more goes on to the edit distance; changed places and a moved word count as edits."""
    a = list(range(100, 160))
    swapped = [*a[:10], -1, -2, *a[12:]]
    moved = [*a[1:], a[0]]              # 60 places, two edits
    pairs = spark.createDataFrame([(a, swapped, 2), (a, swapped, 1), (a, moved, 2), (a, moved, 1), (a, [*a, 7], 1), (a, [*a, 7], 0), ([], [], 0)],
                                  "a array<bigint>, b array<bigint>, most int")
    got = pairs.select(line_dedup.within(F.col("a"), F.col("b"), F.col("most")).alias("near")).collect()
    assert [r.near for r in got] == [True, False, True, False, True, False, True]


def test_block_keys_tell_pair_and_bits(spark):
    """One integer a pair of blocks: equal for two fingerprints where they agree on the pair's bits, and for no other pair."""
    rng = random.Random(4)
    fps = [rng.getrandbits(64) - (1 << 63) for _ in range(30)]
    fps += [f ^ 1 << rng.randrange(63) for f in fps] + [0, -1, 1, -(1 << 63)]
    for distance in (0, 1, 3, 8):
        keys, slot = line_dedup.block_keys(F.col("fp"), distance)
        masks = line_dedup.block_masks(distance)
        table = spark.createDataFrame([(f,) for f in fps], "fp bigint")
        rows = table.select("fp", F.posexplode(F.array(*keys))).select("fp", "pos", "col", slot(F.col("col")).alias("slot")).collect()
        assert len(keys) == len(masks) and all(r.slot == r.pos for r in rows)
        alike = {}
        for r in rows:
            alike.setdefault(r.col, set()).add((r.pos, r.fp & masks[r.pos]))
        assert all(len(v) == 1 for v in alike.values())
        assert len(alike) == len({v for some in alike.values() for v in some})


def test_gaps_are_the_ranges_they_list(spark):
    plain = (r"[\x00-\x2F\x3A-\x60\x7B-\x7F\u00A0-\u00A9\u00AB-\u00B4\u00B6-\u00B9\u00BB-\u00BF\u2000-\u206F\u3000-\u303F"
             r"\uFF01-\uFF0F\uFF1A-\uFF20\uFF3B-\uFF40\uFF5B-\uFF65]+")
    signs = spark.range(0x10000).where("id < 55296 OR id > 57343").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    found = signs.select(*[F.length(F.regexp_replace("c", p, "")).alias(n) for n, p in (("a", plain), ("b", line_dedup.GAPS))])
    assert found.where("a <> b").count() == 0 and found.where("b = 0").count() == 336


def test_fingerprints_of_a_line_are_counted_without_wide_rows(spark):
    """Sums of a line's words, not a column a word; repeated rows stay apart, lines without words have none."""
    rows = [(1, [5, 7, 4]), (1, [5, 7, 4]), (2, []), (3, [-1] * 300)]
    out = line_dedup.with_simhash(spark.createDataFrame(rows, "i int, h array<bigint>"), 1)
    assert sorted(out.collect(), key=str) == sorted([(1, 5), (1, 5), (2, None), (3, -1)], key=str)

    def widest(node):
        return max([node.output().size()] + [widest(node.children().apply(k)) for k in range(node.children().size())])
    assert widest(out._jdf.queryExecution().optimizedPlan()) < 40


def test_lines_are_split_as_one_text(spark):
    """Whole texts are lowered and cut at once: the words and keys are those of each line alone, and no line compiles a pattern."""
    texts = ["ΟΔΟΣ\nΑΣ \nΣΑΣ ΑΣ. Β", "İI  ı\r\n\tTab,, x\u00a0y z\n", " lead and trail \n\n...\n a b c", "x\u2028y \U0001F600 z  w\n\U0001F600 a b", "",
             None, "One  two\u3000three!four", "\n \n", "a,\nb ;c d\x0be\n* **"]
    table = spark.createDataFrame(list(enumerate(texts)), "_uid bigint, _text string").withColumn("_id", F.col("_uid").cast("string"))
    lines = table.select("_uid", F.posexplode(F.split("_text", "\n")).alias("pos", "line"))
    words = lines.select("_uid", "pos", "line", F.array_remove(F.split(F.lower("line"), line_dedup.GAPS), "").alias("w")).collect()
    for short in (False, True):
        out = line_dedup.line_table(table, 3, short)
        got = {(r._uid, r.pos): (r._id, bytes(r.key), r.n, r.fp is None) for r in out.collect()}
        want = {}
        for r in words:
            signs = "\n" + re.sub(r"[\s\x00-\x1f\x7f-\x9f]+", "", r.line)
            if len(r.w) >= 3 or short and (r.w or signs != "\n"):
                want[r._uid, r.pos] = (str(r._uid), hashlib.md5((" ".join(r.w) if r.w else signs).encode()).digest(), len(r.w), len(r.w) < 3)
        assert got == want and len(got) > 6
        assert "split(lower(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_edit_distance_of_random_lines(spark):
    rng = random.Random(21)
    rows = []
    for _ in range(120):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 14))]
        b = list(a)
        for _ in range(rng.randrange(4)):
            at, kind = rng.randrange(len(b) + 1), rng.randrange(3)
            b[at:at + (kind != 1)] = [] if kind == 2 else [rng.randrange(8)]
        rows.append((a, b, rng.randrange(4)))
    pairs = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, most int")
    got = [r.near for r in pairs.select(line_dedup.within(F.col("a"), F.col("b"), F.col("most")).alias("near")).collect()]
    assert got == [word_edits(a, b) <= most for a, b, most in rows] and {True, False} == set(got)


def test_small_tables_are_written_in_few_files(spark):
    """Groups of a few hundred rows are not written as a file for each shuffle partition."""
    cores, held = spark.sparkContext.defaultParallelism, {"spark.sql.shuffle.partitions": str(8 * spark.sparkContext.defaultParallelism),
                                                          "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    shared = shared_dir(spark)
    before = set(os.listdir(shared))
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        pairs = spark.range(600).select(F.col("id").alias("a"), (F.col("id") + F.when(F.col("id") % 5 == 4, 0).otherwise(1)).alias("b"))
        got = {r.id: r.component for r in components(pairs, "few").collect()}
        texts = [f"{prose(random.Random(i // 2), 30)} word{i % 2}" for i in range(200)]
        assert line_dedup.dedup_lines(docs(spark, texts)).count() == 200
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 5 for i in range(600)}
    files = {d: sum(f.endswith(".parquet") for f in os.listdir(f"{shared}/{d}")) for d in set(os.listdir(shared)) - before}
    small = {d: n for d, n in files.items() if re.match(r"few-\d|line-(reps|fps|met|blocks|label|stay|repeated|drops|wanted|words|cc1-\d)", d)}
    assert len(small) > 12 and max(small.values()) <= cores


# --- 8: language model ----------------------------------------------------------------------------

def test_elias_fano_reads_back():
    rng = np.random.default_rng(1)
    for universe in (1, 7, 1000, 1 << 50):
        for n in (0, 1, 5, 3000):
            v = np.sort(rng.integers(0, universe, n)).astype(np.uint64)
            e = lm.EliasFano.encode(v, universe)
            assert (e.range(0, n) == v).all() and (e.range(n // 3, n) == v[n // 3:]).all()


def test_scores_match_a_plain_model(spark):
    rng = random.Random(11)
    texts = [prose(rng, rng.randrange(1, 50)) for _ in range(120)] + AWKWARD
    rows = {r.doc_id: r for r in lm.score(clash(docs(spark, texts)), quality.held_out("id", 1)).collect()}
    toks = [(t or "").encode().lower().split() + [lm.END] for t in texts]
    train = [quality.crc_remainder(i) != 1 for i in range(len(texts))]
    c, bi, fan, total = Counter(), Counter(), Counter(), Counter()
    for t, own in zip(toks, train):
        if own:
            c.update(t)
            bi.update(zip([lm.START] + t, t))
    for (a, _), k in bi.items():
        fan[a] += 1
        total[a] += k
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(toks):
        p1 = [(c[w] + 0.5) / (n + 0.5 * (v + 1)) for w in t]
        p2 = [(max(bi[a, w] - 0.75, 0) + 0.75 * fan[a] * p) / total[a] if total[a] else p for a, w, p in zip([lm.START] + t, t, p1)]
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(c[w] > 0 for w in t), n, not train[i])
        assert math.isclose(r.base_score, sum(map(math.log10, p1)), rel_tol=1e-9)
        assert math.isclose(r.score, sum(map(math.log10, p2)), rel_tol=0.02, abs_tol=0.05)
    assert lm.score(docs(spark, []), quality.held_out("id", 1)).count() == 0


def test_a_frequent_context_is_spread_over_shards(spark):
    """Half of all bigrams follow one word: no shard gets much more than its share."""
    texts = [" ".join(f"hot w{i}x{k}" for k in range(200)) for i in range(40)]
    table = docs(spark, texts).select(F.col("doc_id").alias("id"), F.lit(False).alias("f"), F.col("text").alias("t"))
    load = Counter()
    for r in lm._ask(lm._pack(table), 16).select("shard", F.length("pairs").alias("n")).collect():
        load[r.shard] += r.n
    assert max(load.values()) < 2 * sum(load.values()) / 16


def test_a_batch_sends_few_bytes_a_bigram(spark):
    """A shard's contexts are sent once, in order, with the numbers of their successors; numbers read back as they were."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(2000)) for _ in range(40)]
    table = docs(spark, texts).select(F.col("doc_id").alias("id"), F.lit(False).alias("f"), F.col("text").alias("t"))
    rows = lm._ask(lm._pack(table), 16).drop("shard", "batch", "words", "count", "starts").toPandas()
    assert rows.map(len).to_numpy().sum() < 12 * rows["key"].map(len).sum() / 5
    for kind in ("u1", "<u4", "<i8"):
        for n in (0, 1, 1000):
            a = np.random.default_rng(n).integers(0, 200, n).astype(kind)
            assert (lm._decoded(lm._coded(a), kind) == a).all()


# --- 9: embeddings --------------------------------------------------------------------------------

def test_embeddings_match_all_pairs(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 24))
    for i in range(0, 200, 4):
        for j in range(1, 4):
            x[i + j] = x[i] + rng.normal(size=24) * 0.06 * j
    x[250:255] = x[240]
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [None] + [1.0] * 23), (904, [float("nan")] * 24), (905, [1.0, 2.0]), (905, [1.0, 2.0])]
    got = embeddings.near_duplicates(clash(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))).collect()
    assert len(got) == len(rows)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.9).sum(axis=1) - 1
    links = {r.vec_id: r.n_links for r in got}
    assert all(links[i] <= near[i] for i in range(300))
    assert sum(links[i] for i in range(300)) >= 0.9 * near.sum()
    assert [links[i] for i in (900, 901, 902, 903, 904, 905)] == [0, 0, 0, 0, 0, 1]
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert {r.component_id for r in got if 250 <= r.vec_id < 255} == {240}
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


# --- 10: toxicity ---------------------------------------------------------------------------------

def test_toxicity_catches_terms(spark):
    rng = random.Random(13)
    texts = []
    for i in range(400):
        w = prose(rng, 60).split()
        if i % 4 == 0:
            for _ in range(rng.randrange(1, 6)):
                w[rng.randrange(60)] = rng.choice(["scumbag,", "vilest", "Vilely"])
        texts.append(" ".join(w))
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(3, 1, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs(spark, texts), labels)
    assert model.cuts[0] < model.cuts[1]
    rows = toxicity.score(clash(docs(spark, texts + AWKWARD)), model).collect()
    held = [r for r in rows if r.held_out and r.doc_id < 400]
    assert held and all(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert all(0 <= r.severity <= 2 and r.predicted == 0 for r in rows if r.doc_id >= 400)
    none = toxicity.train(docs(spark, texts), labels.limit(0))
    assert {r.grade for r in toxicity.score(docs(spark, texts[:3]), none).collect()} == {0}
    assert toxicity.score(docs(spark, []), model).count() == 0


def test_toxicity_learns_one_row_an_id(spark, monkeypatch):
    """An id with a third of all rows is one row of the sample."""
    texts = [f"{'scumbag' if i % 4 == 0 else 'kind'} words of {i}" for i in range(40)]
    ids = [1] * 20 + list(range(20, 40))
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(40)], "doc_id bigint, quality int, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda rows: seen.update(n=rows.count()))
    toxicity.train(docs(spark, texts, ids), labels)
    assert seen["n"] == sum(quality.crc_remainder(i) != 0 for i in {1, *range(20, 40)})

"""Byte-level BPE against its library, the manifest and the conversation repair against brute force."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from safetylake.llm import byte_bpe, merkle, repair
from safetylake.llm.ranking import ranked

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TURNS = "conv_id bigint, turn bigint, role string, text string"
LETTERS = " \n\t'abcdlrestvm0129é漢字かな.,!?ABC　\x1c"


def sha(text):
    return sha256(text.encode()).hexdigest()


# --- places in groups -------------------------------------------------------------------------------

def test_ranked_places_every_row_of_hot_and_null_groups(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b", "b", "b"]), rng.choice([None, 1, 2, 3, 3, 3]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(7)
    got = sorted((r.g or "", r._rank, -1 if r.x is None else r.x) for r in ranked(df, ["g"], ["x"], "test").collect())
    want = []
    for g in (None, "a", "b"):
        xs = sorted(-1 if x is None else x for k, x, _ in rows if k == g)
        want += [(g or "", i, x) for i, x in enumerate(xs)]
    assert got == sorted(want)
    assert ranked(df.limit(0), ["g"], ["x"], "test").count() == 0


# --- op11 -------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.load(*byte_bpe.defaults())


@pytest.fixture(scope="module")
def library(encoder):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=byte_bpe.defaults()[1], mergeable_ranks=encoder.ranks.id, special_tokens={})


def some_text(rng, n=80):
    return "".join(rng.choice(LETTERS) for _ in range(rng.randrange(n)))


def test_prefix_tables_equal_the_library(encoder, library):
    rng = random.Random(5)
    vocabulary = list(encoder.ranks.id)
    texts = [some_text(rng) for _ in range(800)]
    texts += [b"".join(rng.choice(vocabulary) for _ in range(4)).decode("utf8", "ignore") for _ in range(800)]
    texts += ["", " ", "\n\n  x", "a" * 3000, "漢字" * 900, " " * 700, "it's we'll 'r 'l <|endoftext|>", "\U0001f600‍́"]
    for t in texts:
        shown, ids = encoder.encode(t)
        assert [int(i) for i in shown.split(",") if i] == library.encode_ordinary(t)
        assert encoder.decode(ids) == t.encode()


def test_every_prefix_has_its_own_encoding_and_appends_are_exact(encoder):
    ranks = encoder.ranks
    data = "unbelievably  Übergröße漢字漢字".encode()
    table = byte_bpe.Prefixes(ranks, data[:5])
    table.append(data[5:])
    for end in range(len(data) + 1):
        assert table.ids(end) == ranks.merged(data[:end])
    assert list(table.last) == list(byte_bpe.Prefixes(ranks, data).last)


def test_edits_compute_little_anew_and_equal_a_fresh_encoding(encoder, library):
    rng = random.Random(6)
    for _ in range(300):
        e = byte_bpe.EditedText(encoder, some_text(rng))
        for _ in range(4):
            lo = rng.randrange(len(e.text) + 1)
            e.edit(lo, min(len(e.text), lo + rng.randrange(6)), some_text(rng, 6))
            assert e.ids() == library.encode_ordinary(e.text)
        e.append(some_text(rng, 9))
        assert e.ids() == library.encode_ordinary(e.text)
    long = byte_bpe.EditedText(encoder, "".join(rng.choice("abcdefg") for _ in range(20000)))
    assert long.edit(9000, 9001, "x") < 200         # one match without a gap, yet only the part near the edit
    assert long.ids() == library.encode_ordinary(long.text)


def test_byte_bpe_operators_keep_rows_and_columns(spark, encoder, library):
    texts = [None, "", "   ", "same", "same", "\u0000 é\n\nx", "word " * 4000, "漢" * 3000]
    rows = [(None if i == 3 else i, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("i", "t", "ids", "row", "decoded", "n_anew"):
        df = df.withColumn(c, F.lit("clash"))
    got = byte_bpe.encode(df)
    assert sorted((r.row.text or "", tuple(r.ids)) for r in got.collect()) == sorted(
        (t or "", tuple(library.encode_ordinary(t or ""))) for t in texts)
    back = byte_bpe.decode(got.select("row.doc_id", "row.text", "ids").withColumn("row", F.lit(1)))
    assert all(bytes(r.decoded) == (r.row.text or "").encode() for r in back.collect())
    trip = byte_bpe.round_trip(df).collect()
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in trip) == sorted(
        (len(i), sha(",".join(map(str, i))), sha(t or "")) for t in texts for i in [library.encode_ordinary(t or "")])
    assert byte_bpe.round_trip(df.limit(0)).count() == 0
    changes = spark.createDataFrame([("hello world", 2, 4, "LL"), (None, None, None, "new"), ("abc", 1, 99, None), ("x y", 2, 1, "é")],
                                    "text string, lo int, hi int, put string")
    assert {(r.text, tuple(r.ids)) for r in byte_bpe.edited(changes, "lo", "hi", "put").collect()} == {
        (t, tuple(library.encode_ordinary(t))) for t in ("heLLo world", "new", "a", "x éy")}


# --- op12 -------------------------------------------------------------------------------------------

def plain_leaf(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def plain_tree(nodes):
    """Levels of one tree, bottom first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([sha("".join(at[i:i + 3])) for i in range(0, len(at), 3)])
    return levels


def plain_path(levels, i):
    for level in levels[:-1]:
        run = level[i // 3 * 3:i // 3 * 3 + 3]
        yield "".join(run[:i % 3]), "".join(run[i % 3 + 1:])
        i //= 3


def plain_manifest(rows):
    sources = {}
    for r in rows:
        cut = r[1].replace("\n", "") if r[1] and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[1]
        sources.setdefault(r[3], []).append((-1 if r[0] is None else r[0], plain_leaf(r, r[1]), plain_leaf(r, cut)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[1] for x in sorted(sources[s])]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    for j, s in enumerate(order):
        for i, (doc_id, digest, now) in enumerate(sorted(sources[s])):
            path = [*plain_path(trees[s], i), *plain_path(top, j)]
            for left, right in path:
                now = sha(left + now + right)
            yield (None if doc_id == -1 else doc_id, digest, trees[s][-1][0], top[-1][0],
                   sha("".join(left + right for left, right in path)), now, now == top[-1][0])


@pytest.mark.parametrize("levels", [merkle.LEVELS, 1, 2])
def test_manifest_equals_plain_trees(spark, levels):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a\nb", "x", None, "", "\n", "é\n" * 50]), rng.choice(["en", None]),
             rng.choice(["hot", "hot", "hot", "b", None, "é", "z"]), rng.choice([None, 3])) for i in range(150)]
    rows += [(i, "lone", "en", f"only{i}", 1) for i in range(1000, 1005)]
    rows += [rows[3]] * 4 + [(7, "other\n", "en", "hot", 2), (None, "n\n", "en", "hot", 2), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = [tuple(r) for r in merkle.report(merkle.manifest(merkle.leaves(df), levels=levels)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_manifest(rows)))
    assert {r[-1] for r in got} == {True, False}


def test_manifest_keeps_clashing_columns_and_takes_few_rows(spark):
    rows = [(1, "a\n", "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    made = merkle.leaves(df).withColumns({c: F.lit("clash") for c in ("_tree", "_rank", "digest", "row", "_block", "_id")})
    out = merkle.manifest(made).collect()
    assert len(out) == 1 and out[0].root == out[0].subroot == out[0].leaf and out[0]._tree == out[0].digest == "clash"
    one = merkle.report(merkle.manifest(merkle.leaves(df))).first()
    assert one.proof_sha256 == sha("")
    assert merkle.report(merkle.manifest(merkle.leaves(df.limit(0)))).count() == 0


# --- op13 -------------------------------------------------------------------------------------------

OPTIONS = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]]
FORM = re.compile(r"(s?(ua)+)?")


def cheapest(turns):
    """Smallest (cost, audit) over every way to edit a short conversation."""
    best = None
    for gaps in itertools.product(OPTIONS, repeat=len(turns) + 1):
        for acts in itertools.product(*[["D"] if f in ("blank", "duplicate") else ["D", "K", "u", "a"] for _, f in turns]):
            shape, audit, cost = "".join(gaps[0]), "I" * len(gaps[0]), 3 * len(gaps[0])
            for (initial, fault), act, gap in zip(turns, acts, gaps[1:]):
                if act == "D":
                    audit, cost = audit + "D", cost + 4
                else:
                    shape += initial if act == "K" else act
                    audit += "K" if act == "K" else "R"
                    cost += (act != "K") * 3 + (fault == "truncated") * 3
                shape += "".join(gap)
                audit += "I" * len(gap)
                cost += 3 * len(gap)
            if FORM.fullmatch(shape) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_repair_finds_the_cheapest_edits():
    rng = random.Random(8)
    assert len(repair.ROLES.moves) == 5
    for _ in range(60):
        turns = [(rng.choice("ssuuuaaat"), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(4))]
        assert repair.folded([repair.swept(turns, [0])]) == cheapest(turns)


def test_tables_of_blocks_compose():
    rng = random.Random(9)
    for _ in range(40):
        turns = [(rng.choice("suuuaaatx"), rng.choice(["", "", "blank", "truncated"])) for _ in range(rng.randrange(1, 60))]
        cuts = sorted(rng.sample(range(len(turns) + 1), min(3, len(turns))))
        parts = [p for a, b in zip([0, *cuts], [*cuts, len(turns)]) if (p := turns[a:b])]
        tables = [repair.swept(p, range(5) if i else [0]) for i, p in enumerate(parts)]
        assert repair.folded(tables) == repair.folded([repair.swept(turns, [0])])


def plain_conversation(rows):
    """Counts and repaired text of one conversation's damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, found = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append((role[:1], fault))
    at = [r[0] for r in rows if r[0] is not None]
    gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
    illegal = sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(found, found[1:]))
    cost, audit = repair.folded([repair.swept(found, [0])])
    out, k, turn = [], 0, iter(rows)
    for edit in audit:
        role, text = next(turn)[1:] if edit != "I" else ("", "")
        if edit == "D":
            continue
        last = out[-1][0][:1] if out else ""
        out.append((role if edit == "K" else "assistant" if last == "u" else "user", text))
    assert FORM.fullmatch("".join(r[:1] for r, _ in out))
    counts = [sum(f == k for _, f in found) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))


def plain_repairs(rows):
    whole = {}
    for c, t, role, text in rows:
        kept = whole.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {(c, *plain_conversation(kept)) for c, kept in whole.items()}


@pytest.mark.parametrize("block", [repair.BLOCK, 3])
def test_repairs_equal_a_plain_loop(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(10)
    rows = [(c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
             rng.choice(["Fine.", "Fine.", "cut", " ", None, "", "What?\n", "a. b", "x" * 3000, f"own {t}!"]))
            for c in [*range(40), None] for t in rng.sample([None, *range(12)], rng.randrange(1, 9))]
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t // 2 % 90}.") for t in range(400)]       # a hot conversation
    rows += [(101, 1, "user", "tie."), (101, 1, "assistant", "tie."), (101, 1, "user", "tie."), (102, 3, "user", "one row")]
    rows += [(200 + i, 0, "user", "x") for i in range(60)]          # some of these lose their only row
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("clash") for c in ("c", "k", "found", "block", "col")})
    turns = repair.damage(df)
    found = repair.repairs(turns, df)
    got = {tuple(r) for r in repair.report(turns, found).collect()}
    assert got == plain_repairs(rows)
    assert any(r[7] == "" for r in got)
    made = repair.rewritten(turns, found).where("conv_id = 100").orderBy("place").collect()
    assert FORM.fullmatch("".join(r.role[0] for r in made)) and [r.place for r in made] == list(range(len(made)))
    assert repair.report(repair.damage(df.limit(0)), repair.repairs(repair.damage(df.limit(0)), df.limit(0))).count() == 0

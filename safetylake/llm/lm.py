"""Language-model scoring with an Elias-Fano n-gram trie, sharded by bigram.

Counts come from every training document. Documents are packed into batches of
token indexes; a batch sends each shard the distinct words and bigrams that
belong to it with their training counts, so a word or pair costs one entry a
batch however often it occurs. Words are dealt by their hash and bigrams by the
hash of both words, so the successors of a frequent word are spread over all
shards. What is stored or sent is deflated, contexts in order by their distances.
A shard merges the counts into a two-level trie: contexts in hash order, a
monotone pointer sequence to each context's successors, and successors as
increasing keys inside their context's range. Pointers and successors are
Elias-Fano coded; the absolute-discounted counts are quantised to 8 bits by
quantiles. Levels are memory-mapped files of the task that queries them. The shard
answers the batches' own entries; how many successors a word has is then summed
over the shards; the batch divides by the context's total and adds the answers up:

    P(w | v) = p_trie(w | v) + backoff(v) * P(w),
    P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)).

Words are known by a 64-bit hash, successors inside a context by 40 bits of it.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

END, START = b" end", b" start"         # a word holds no space, so neither is one
KEY_BITS = 40                           # of a successor's hash
DISCOUNT = 0.75
BATCH_TOKENS = 1_500_000
SENT_BYTES = 4_000_000                  # of a batch's words and bigrams that leave a worker at once


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def _coded(values: np.ndarray) -> bytes:
    """Numbers by their bytes of one place after the other, runs and frequent bytes shortened."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    z = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_RLE)
    return z.compress(planes.tobytes()) + z.flush()


def _decoded(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw, -15), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _narrow(counts: np.ndarray) -> np.ndarray:
    """The counts in 1, 2 or 4 bytes each, as the largest needs."""
    most = counts.max(initial=0)
    return counts.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4")


class EliasFano:
    """An increasing sequence of integers: low bits packed, high bits in unary.

    ``range`` selects a position by the popcounts of the high bits' 64-bit words,
    kept as one running sum a word, and reads on from there.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray, width: int, size: int):
        self.low, self.high, self.rank, self.width, self.size = low, high, rank, width, size

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> "EliasFano":
        n = len(values)
        width = max(0, int(np.floor(np.log2(max(1, universe) / n)))) if n else 0
        v = values.astype(np.uint64)
        step = np.uint64(width)
        at = (v >> step) + np.arange(n, dtype=np.uint64)
        high = np.zeros((int(at[-1]) >> 6) + 1 if n else 1, dtype=np.uint64)
        np.bitwise_or.at(high, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        low = np.zeros((n * width + 63) // 64 + 2, dtype=np.uint64)
        if width:
            bits = v & np.uint64((1 << width) - 1)
            pos = np.arange(n, dtype=np.uint64) * step
            word, off = (pos >> np.uint64(6)).astype(np.int64), pos & np.uint64(63)
            np.bitwise_or.at(low, word, bits << off)
            over = off + step > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, bits[over] >> (np.uint64(64) - off[over]))
        rank = np.concatenate([[0], np.cumsum(np.bitwise_count(high))]).astype(np.int64)
        return EliasFano(low, high, rank, width, n)

    def _low(self, i: np.ndarray) -> np.ndarray:
        pos = i.astype(np.uint64) * np.uint64(self.width)
        w, off = (pos >> np.uint64(6)).astype(np.int64), pos & np.uint64(63)
        v = self.low[w] >> off
        spill = off + np.uint64(self.width) > np.uint64(64)
        v = np.where(spill, v | (self.low[w + 1] << ((np.uint64(64) - off) & np.uint64(63))), v)
        return v & np.uint64((1 << self.width) - 1)

    def range(self, lo: int, hi: int) -> np.ndarray:
        """Values at positions lo to hi - 1: select the first one, then read on."""
        if hi <= lo:
            return np.zeros(0, dtype=np.uint64)
        a = int(np.searchsorted(self.rank, lo, side="right")) - 1
        z = int(np.searchsorted(self.rank, hi - 1, side="right"))
        ones = np.nonzero(np.unpackbits(np.ascontiguousarray(self.high[a:z]).view(np.uint8), bitorder="little"))[0]
        skip = lo - int(self.rank[a])
        i = np.arange(lo, hi, dtype=np.int64)
        out = ((a << 6) + ones[skip:skip + hi - lo] - i).astype(np.uint64) << np.uint64(self.width)
        return out | self._low(i) if self.width else out


class Trie:
    """Contexts, pointers, successors and 8-bit discounted counts of one shard."""

    def __init__(self, contexts: np.ndarray, ctx: np.ndarray, nxt: np.ndarray, count: np.ndarray):
        """``contexts`` sorted hashes; bigrams sorted by (context position, successor key)."""
        n = len(contexts)
        self.contexts = contexts
        self.fan = fan = np.bincount(ctx, minlength=n)
        self.pointers = EliasFano.encode(np.concatenate([[0], np.cumsum(fan)]), len(ctx) + 1)
        # successors increase inside a context; the running context offset makes the level monotone
        # in relative keys: key scaled to the context's own fan-out keeps the universe small
        self.successors = EliasFano.encode((ctx.astype(np.uint64) << np.uint64(KEY_BITS)) | nxt, max(1, n) << KEY_BITS) \
            if n < 1 << (63 - KEY_BITS) else None
        if self.successors is None:
            raise ValueError("too many contexts in one shard: raise the number of shards")
        p = np.log10(count - DISCOUNT) if len(ctx) else np.zeros(0)
        self.book = np.unique(np.quantile(p, np.linspace(0, 1, 255), method="nearest")).astype(np.float32) if len(p) else np.zeros(1, np.float32)
        mid = (self.book[1:] + self.book[:-1]) / 2
        self.code = (np.searchsorted(mid, p) + 1).astype(np.uint8)          # 0: not seen

    def mapped(self, folder: str) -> "Trie":
        """Move the large levels to memory-mapped files of the folder."""
        def move(a: np.ndarray, name: str) -> np.ndarray:
            path = os.path.join(folder, name)
            a.tofile(path)
            if not a.size:
                return a
            with open(path, "rb") as f:
                view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            return np.frombuffer(view, dtype=a.dtype)

        for name, level in (("pointers", self.pointers), ("successors", self.successors)):
            for part in ("low", "high", "rank"):
                setattr(level, part, move(getattr(level, part), f"{name}.{part}"))
        self.code = move(self.code, "code")
        return self

    def find(self, ctx: np.ndarray, nxt: np.ndarray, block: int = 1 << 20) -> np.ndarray:
        """Codes of bigrams given by context position; 0 where unseen.

        Contexts are taken in runs of about ``block`` successors: the pointers give
        a run's range, its successors are read from the coded level, and each key
        is looked for by successor search relative to its context.
        """
        out = np.zeros(len(ctx), dtype=np.uint8)
        n = len(self.contexts)
        pointers = self.pointers.range(0, n + 1).astype(np.int64)
        by_ctx = np.argsort(ctx, kind="stable")
        sorted_ctx = ctx[by_ctx]
        c0 = 0
        while c0 < n:
            c1 = max(c0 + 1, int(np.searchsorted(pointers, pointers[c0] + block, side="right")) - 1)
            lo, hi = int(pointers[c0]), int(pointers[c1])
            ask = by_ctx[np.searchsorted(sorted_ctx, c0):np.searchsorted(sorted_ctx, c1)]
            if hi > lo and len(ask):
                level = self.successors.range(lo, hi)
                want = (ctx[ask].astype(np.uint64) << np.uint64(KEY_BITS)) | nxt[ask]
                at = np.minimum(np.searchsorted(level, want), len(level) - 1)
                hit = level[at] == want
                out[ask[hit]] = self.code[lo + at[hit]]
            c0 = c1
        return out


def _pack(docs: DataFrame) -> DataFrame:
    """Batches: ``(batch, ids, sizes, words, tokens, train, n)``, one row for up to ``BATCH_TOKENS`` tokens."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        index: dict[bytes, int] = {END: 0}
        ids: list = []
        folds: list = []
        sizes: list[int] = []
        chunks: list[np.ndarray] = []

        def row() -> pd.DataFrame:
            words = np.fromiter(map(word_hash, index), dtype=np.uint64, count=len(index))
            tokens = np.concatenate(chunks)
            return pd.DataFrame({"batch": [(part << 32) | seq], "ids": [ids], "folds": [folds],
                                 "sizes": [np.array(sizes, dtype="<i4").tobytes()], "words": [words.tobytes()],
                                 "tokens": [_coded(tokens)], "n": [len(tokens)]})

        held = 0
        for b in batches:
            for i, f, t in zip(b["id"], b["f"], b["t"]):
                words = t.encode("utf-8", "surrogatepass").lower().split() if t else []
                for w in words:
                    if w not in index:
                        index[w] = len(index)
                words.append(END)
                chunks.append(np.fromiter(map(index.__getitem__, words), dtype="<i4", count=len(words)))
                ids.append(None if pd.isna(i) else i)
                folds.append(bool(f))
                sizes.append(len(words))
                held += len(words)
                if held >= BATCH_TOKENS:
                    yield row()
                    seq += 1
                    index, ids, folds, sizes, chunks, held = {END: 0}, [], [], [], [], 0
        if ids:
            yield row()

    return docs.select("id", "f", "t").mapInPandas(
        run, f"batch bigint, ids array<{kind}>, folds array<boolean>, sizes binary, words binary, tokens binary, n bigint")


def _bigrams(r) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: word hashes (the start mark last), token indexes, contexts, sizes, train flag a token, document ends."""
    words = np.concatenate([np.frombuffer(r.words, dtype=np.uint64), [np.uint64(word_hash(START))]])
    tokens = _decoded(r.tokens, "<i4")
    sizes = np.frombuffer(r.sizes, dtype="<i4").astype(np.int64)
    ends = np.cumsum(sizes)
    prev = np.empty(len(tokens), dtype=np.int64)
    prev[1:] = tokens[:-1]
    prev[ends - sizes] = len(words) - 1
    train = np.repeat(~np.array(r.folds, dtype=bool), sizes)
    return words, tokens.astype(np.int64), prev, sizes, train, ends


def _plan(r, shards: int):
    words, tokens, prev, sizes, train, ends = _bigrams(r)
    shard = (words % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((words, shard))
    place = np.empty(len(words), dtype=np.int64)
    place[order] = np.arange(len(words))
    words, shard = words[order], shard[order]
    cur, ctx = place[tokens], place[prev]
    pair, at = np.unique(ctx * len(words) + cur, return_inverse=True)
    pc, pn = pair // len(words), pair % len(words)
    # a bigram's shard is that of both words; pairs of a shard are ordered by the hash of their contexts
    home = _home(words[pc], words[pn] >> np.uint64(64 - KEY_BITS), shards)
    order = np.lexsort((words[pc], home))
    place = np.empty(len(pc), dtype=np.int64)
    place[order] = np.arange(len(pc))
    return words, shard, cur, ctx, pc[order], pn[order], home[order], place[at], sizes, train, ends


def _home(ctx: np.ndarray, key: np.ndarray, shards: int) -> np.ndarray:
    mixed = (ctx ^ (key * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _ask(packed: DataFrame, shards: int) -> DataFrame:
    """One row per batch and shard: its words, and its bigrams by ``heads``, each with ``runs`` keys, with training counts."""
    names = ["shard", "batch", "words", "count", "starts", "heads", "runs", "key", "pairs"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                words, shard, cur, ctx, pc, pn, home, at, sizes, train, ends = _plan(r, shards)
                wc = np.bincount(cur[train], minlength=len(words))
                starts = np.zeros(len(words), dtype=np.int64)
                first = (ends - sizes)[train[ends - 1]]
                np.add.at(starts, ctx[first], 1)        # the start mark is a context, not a token
                bc = np.bincount(at[train], minlength=len(pc))
                key = words[pn] >> np.uint64(64 - KEY_BITS)
                del cur, ctx, at, train, pn
                ws = np.searchsorted(shard, np.arange(shards + 1))
                ps = np.searchsorted(home, np.arange(shards + 1))
                rows, held = [], 0
                for s in range(shards):
                    w, p = slice(ws[s], ws[s + 1]), slice(ps[s], ps[s + 1])
                    if ws[s] < ws[s + 1] or ps[s] < ps[s + 1]:
                        head = np.flatnonzero(np.diff(pc[p], prepend=-1))
                        low = key[p].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BITS // 8]
                        rows.append((s, r.batch, words[w].tobytes(), _coded(wc[w].astype("<u4")), _coded(starts[w].astype("<u4")),
                                     _coded(np.diff(words[pc[p][head]], prepend=np.uint64(0))), _coded(np.diff(head, append=len(low)).astype("<u4")),
                                     np.ascontiguousarray(low).tobytes(), _narrow(bc[p]).tobytes()))
                        held += sum(map(len, rows[-1][2:]))
                    if rows and (held >= SENT_BYTES or s == shards - 1):
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0

    return packed.mapInPandas(run, "shard int, batch bigint, words binary, count binary, starts binary, heads binary, runs binary, key binary, pairs binary")


def _keys(raw: bytes) -> np.ndarray:
    size = KEY_BITS // 8
    out = np.zeros((len(raw) // size, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, size)
    return out.view("<u8").ravel().astype(np.uint64)


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(keys, return_inverse=True)
    return u, np.bincount(at, weights=counts, minlength=len(u)).astype(np.int64)


ANSWER = ("batch bigint, shard int, words binary, count binary, seen binary, codes binary, book binary, "
          "n_train bigint, n_words bigint, fans binary")


def _answer(shards: int):
    """Build one shard's trie from all batches, then answer each batch.

    Rows without a batch carry the numbers of successors found here to the shards of their words.
    """
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(w, dtype=np.uint64) for w in rows["words"]]
        heads = [np.cumsum(_decoded(w, "<u8"), dtype=np.uint64) for w in rows["heads"]]
        read = lambda c: [_decoded(x, "<u4").astype(np.int64) for x in rows[c]]
        count, starts, runs = (read(c) for c in ("count", "starts", "runs"))
        nxt = [_keys(k) for k in rows["key"]]
        pairs = [np.frombuffer(x, dtype=f"<u{len(x) // max(1, len(k))}" if x else "u1").astype(np.int64) for x, k in zip(rows["pairs"], nxt)]
        known, total = _merge(np.concatenate(words), np.concatenate(count))
        _, begun = _merge(np.concatenate(words), np.concatenate(starts))
        contexts = np.unique(np.concatenate(heads))
        every_ctx = np.concatenate([np.repeat(np.searchsorted(contexts, h), c) for h, c in zip(heads, runs)])
        every_nxt, every_n = np.concatenate(nxt), np.concatenate(pairs)
        some = every_n > 0
        order = np.lexsort((every_nxt[some], every_ctx[some]))
        c, k, n = every_ctx[some][order], every_nxt[some][order], every_n[some][order]
        del every_n, order
        new = np.ones(len(c), dtype=bool)
        new[1:] = (c[1:] != c[:-1]) | (k[1:] != k[:-1])
        at = np.nonzero(new)[0]
        n = np.add.reduceat(n, at) if len(at) else n
        # what follows a context: its tokens, less the end mark that nothing follows, or the starts it stands for
        seen = np.where(known == np.uint64(word_hash(END)), 0, total) + begun
        trie = Trie(contexts, c[at], k[at], n)
        fan = trie.fan
        with tempfile.TemporaryDirectory() as folder:           # gone when the shard is done
            trie = trie.mapped(folder)
            codes = trie.find(every_ctx, every_nxt)
            book = trie.book.astype("<f4").tobytes()
            del trie
        cut = np.cumsum([0] + [len(x) for x in nxt])
        own = [np.searchsorted(known, w) for w in words]        # positions of a batch's words
        out = [(b, key[0], w.tobytes(), _coded(total[o].astype("<i8")), _coded(seen[o].astype("<i8")),
                _coded(codes[cut[i]:cut[i + 1]]), book, 0, 0, None)
               for i, (b, w, o) in enumerate(zip(rows["batch"], words, own))]
        out[0] = out[0][:7] + (int(total.sum()), int((total > 0).sum()), None)
        to = (contexts % np.uint64(shards)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        order = order[fan[order] > 0]
        ends = np.searchsorted(to[order], np.arange(shards + 1))
        for s in np.unique(to[order]):
            o = order[ends[s]:ends[s + 1]]
            out.append((None, int(s), contexts[o].tobytes(), None, None, None, None, 0, 0, _coded(fan[o].astype("<u4"))))
        got = pd.DataFrame(out, columns=[c.split()[0] for c in ANSWER.split(", ")])
        return got.astype({"batch": "Int64"})

    return run


def _fans(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Successors of each batch's words of one shard, summed over the shards that found some."""
    found = rows[rows["batch"].isna()]
    asked = rows[rows["batch"].notna()]
    words, fan = _merge(np.concatenate([np.zeros(0, dtype=np.uint64)] + [np.frombuffer(w, dtype=np.uint64) for w in found["words"]]),
                        np.concatenate([np.zeros(0)] + [_decoded(f, "<u4") for f in found["fans"]]))
    words, fan = np.append(words, np.uint64(0)), np.append(fan, 0)      # so that a search never leaves the arrays
    out = []
    for b, raw in zip(asked["batch"], asked["words"]):
        own = np.frombuffer(raw, dtype=np.uint64)
        at = np.searchsorted(words[:-1], own)
        out.append((int(b), key[0], _coded(np.where((words[at] == own) & (at < len(words) - 1), fan[at], 0).astype("<i8"))))
    return pd.DataFrame(out, columns=["batch", "shard", "fan"])


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
          shard_tokens: int = 1_000_000, min_shards: int = 64) -> DataFrame:
    """One row per document row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``held_out`` is a boolean column over the id, named ``id`` there; rows where
    it is not false are never learned from. Null and empty texts are one end
    token. Without training rows every probability is the base one over zero
    counts. Equal rows each get a row; an empty table gives none. Only the id
    and text columns are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    packed = staged(_pack(rows.withColumn("f", F.coalesce(held_out, F.lit(True)))), "lm-packed")
    tokens = packed.agg(F.sum("n")).first()[0] or 0
    shards = max(min_shards, -(-tokens // shard_tokens))
    answers = staged(_ask(packed, shards).groupBy("shard").applyInPandas(_answer(shards), ANSWER), "lm-answers")
    fans = (answers.select("batch", "shard", "words", "fans").groupBy("shard")
            .applyInPandas(_fans, "batch bigint, shard int, fan binary"))
    totals = answers.agg(F.sum("n_train").alias("n"), F.sum("n_words").alias("v")).first()
    n, v = totals.n or 0, totals.v or 0

    def finish(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("shard")
        fans, right = right["fan"].dropna(), right[right["fan"].isna()]
        out = []
        for r in left.itertuples():
            words, shard, cur, ctx, pc, pn, home, at, sizes, train, ends = _plan(r, shards)
            count = np.concatenate([_decoded(x, "<i8") for x in right["count"]])
            total = np.concatenate([_decoded(x, "<i8") for x in right["seen"]])
            fan = np.concatenate([_decoded(x, "<i8") for x in fans])
            backoff = np.where(total > 0, DISCOUNT * fan / np.maximum(total, 1), 1.0)
            counts = []
            for codes, book in zip(right["codes"], right["book"]):
                code = _decoded(codes, "u1")
                value = np.concatenate([[0.0], 10.0 ** np.frombuffer(book, dtype="<f4").astype(float)])
                counts.append(value[code])
            p1 = (count + 0.5) / (n + 0.5 * (v + 1))
            p2 = np.concatenate(counts) / np.maximum(total, 1)[pc] + backoff[pc] * p1[pn]
            begin = ends - sizes
            out.append(pd.DataFrame({
                "id": list(r.ids), "held_out": list(r.folds), "n_tokens": sizes,
                "n_known": np.add.reduceat((count[cur] > 0).astype(np.int64), begin), "train_tokens": n,
                "base_score": np.add.reduceat(np.log10(p1)[cur], begin),
                "score": np.add.reduceat(np.log10(p2)[at], begin)}))
        return pd.concat(out)

    shape = (f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
             "base_score double, score double")
    told = (answers.where("batch IS NOT NULL").select("batch", "shard", "codes", "count", "seen", "book")
            .unionByName(fans, allowMissingColumns=True))
    return (packed.groupBy("batch").cogroup(told.groupBy("batch"))
            .applyInPandas(finish, shape).withColumnRenamed("id", id_col))

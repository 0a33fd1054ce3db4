"""Byte-pair tokenizing by a deterministic token automaton.

The merges of a public tokenizer file are compiled, in rank order, by
merge-gadget construction: the automaton starts with one state that every base
symbol leaves and enters; the gadget of merge (a, b) takes the state that ``a``
leads to, splits off a copy without its ``b`` arc, redirects ``a`` there, and
adds an arc ``ab`` to where ``b`` led. All arcs of one label always lead to one
state, so a state is the label that leads to it, plus what the gadgets removed.
The resulting automaton accepts exactly the token sequences that merging would
produce, so encoding a word is following the one accepted path that spells it:
table-driven, left to right, without merging anything. Decoding emits the arc
labels.

Executors read the tokenizer file by its installed path (a parameter).
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Entries kept ready in one worker; beyond it the tables of known words start anew.
KNOWN_WORDS = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Rule: printable Latin-1 bytes stand for themselves, the others take the code
    points from 256 on, in order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    shift = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(shift)) for b in range(256)]


class Automaton:
    """Token automaton over labels; ids are vocabulary ids."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.label = {i: s for s, i in vocab.items()}
        self.end = end
        # A state is (label, time): the arcs of ``label``'s state as of gadget number ``time``.
        self.cut: dict[tuple[int, int], int] = {}       # (label a, label b): when the arc b left a's state
        self.first: dict[int, tuple[int, int]] = {}     # label -> (its first part, when its arc was added)
        self.shares: dict[int, tuple[int, int]] = {}    # label -> (second part, when its state was shared)
        for time, (a, b) in enumerate(merges):
            x, y = vocab[a], vocab[b]
            if self.open(x, y, time):
                z = vocab[a + b]
                if z not in self.first:
                    self.first[z], self.shares[z] = (x, time), (y, time)
                self.cut[x, y] = time
        # words are spelled by the labels that can be reached
        self.by_text: dict[str, int] = {}
        made = set(self.first)
        for s, i in vocab.items():
            if i in made or len(s.removesuffix(end) or s) == 1:
                self.by_text[s] = i
        self.longest = max(map(len, self.by_text), default=1)
        self.pair: dict[tuple[int, int], bool] = {}

    def open(self, x: int, y: int, now: float) -> bool:
        """Whether x's state has an arc y just before gadget ``now``.

        The arc y exists where the arc of its first part existed when y was
        made, and so on down; x's state began as a copy of its second part's.
        """
        right, until = x, now
        while True:
            left, before = y, until
            while True:
                t = self.cut.get((right, left))
                if t is not None and t < before:
                    return False
                made = self.first.get(left)
                if made is None:
                    break
                # an arc is made from the first part's, which the same gadget may cut just after
                left, before = made[0], min(before, made[1] + 1)
            share = self.shares.get(right)
            if share is None:
                return True
            right, until = share[0], min(until, share[1])

    def step(self, x: int, y: int) -> bool:
        known = self.pair.get((x, y))
        if known is None:
            if len(self.pair) > 2_000_000:
                self.pair.clear()
            known = self.pair[x, y] = self.open(x, y, float("inf"))
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one word given as byte symbols, its end mark included as ``end``."""
        n, end, get, longest, pair = len(word), self.end, self.by_text.get, self.longest, self.pair
        # Follow arcs from the left, longest label first. A prefix has one accepted
        # path only, so a position that was reached and left again is dead.
        path: list[int] = []
        at, k, prev = 0, min(n, longest), -1
        dead = bytearray(n + 1)
        sizes: list[int] = []
        while at < n:
            while k:
                to = at + k
                if not dead[to]:
                    t = get(word[at:to] + end if to == n else word[at:to])
                    if t is not None and (prev < 0 or (pair[prev, t] if (prev, t) in pair else self.step(prev, t))):
                        break
                k -= 1
            if k:
                path.append(t)
                sizes.append(k)
                at, prev = to, t
                k = min(n - at, longest)
            else:
                if not path:
                    raise ValueError(f"no path spells {word!r}")
                dead[at] = 1
                path.pop()
                k = sizes.pop()
                at -= k
                prev = path[-1] if path else -1
                k -= 1
        return path


class Tokenizer:
    """Encoder and decoder of one tokenizer file: splitting, byte symbols, automaton."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.end = model.get("end_of_word_suffix") or ""
        self.auto = Automaton(model["vocab"], pairs, self.end)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.label = self.auto.label | {i: s for s, i in self.special.items()}
        steps = spec["normalizer"]["normalizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("unknown normalizer")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("unknown splitter")
        self.words = regex.compile(split["pattern"]["Regex"], regex.V0)
        # Up to U+024F (and some common punctuation) composition changes nothing and all
        # Unicode versions agree on letters and white space; a text with anything else is
        # normalised and split by the file's own library.
        self.odd = regex.compile(r"[^\x00-\x1b\x20-\u024f\u2010-\u2027\u20ac]", regex.V0)
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.marks = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.bytes = byte_symbols()
        self.value = {c: i for i, c in enumerate(self.bytes)}
        self.known: dict[str, bytes] = {}       # split word -> ids
        self.chunks: dict[str, bytes] = {}      # run without white space, as written -> ids

    def word(self, w: str) -> bytes:
        """Ids of one split word."""
        got = self.known.get(w)
        if got is None:
            ids = self.auto.encode("".join(map(self.bytes.__getitem__, w.encode("utf-8"))))
            got = self.known[w] = np.array(ids, dtype="<u4").tobytes()
        return got

    def chunk(self, c: str) -> bytes:
        """Ids of a run without white space; no split word crosses its ends."""
        if len(self.known) + len(self.chunks) >= KNOWN_WORDS:
            self.known.clear()
            self.chunks.clear()
        got = self.chunks[c] = b"".join(map(self.word, self.words.findall(c.lower())))
        return got

    def plain_ids(self, piece: str) -> Iterator[bytes]:
        if self.odd.search(piece):
            symbols = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))
            for w, _ in symbols:
                yield self.word(bytes(map(self.value.__getitem__, w)).decode("utf-8"))
        else:
            get = self.chunks.get
            for c in piece.split():
                ids = get(c)
                yield self.chunk(c) if ids is None else ids

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; null is empty."""
        if not text:
            return b""
        if not (self.marks and "<|" in text):
            return b"".join(self.plain_ids(text))
        out: list[bytes] = []
        at = 0
        for m in self.marks.finditer(text):
            out += self.plain_ids(text[at:m.start()])
            out.append(self.special[m.group()].to_bytes(4, "little"))
            at = m.end()
        out += self.plain_ids(text[at:])
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Arc labels of the path, separated as the file's missing decoder does."""
        return " ".join(map(self.label.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_LOADED: dict[str, Tokenizer] = {}


def load(path: str) -> Tokenizer:
    """One automaton per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """``row`` (all columns), ``ids`` (array<int>): one row per row.

    Null and empty texts have no ids. Columns of any name may be present.
    """
    path = path or default_path()
    schema = docs.select(F.struct("*").alias("row")).schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tok = load(path)
        for b in batches:
            texts = b.column(0).field(text_col).to_pylist()
            for at in range(0, len(texts), 256):        # bounded output batches
                ids = [np.frombuffer(tok.encode(t), dtype="<u4").astype("int32") for t in texts[at:at + 256]]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 256), pa.array(ids, type=pa.list_(pa.int32()))], names=["row", "ids"])

    return docs.select(F.struct("*").alias("row")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """The input's columns as ``row`` and ``decoded``; null ids decode to an empty text."""
    path = path or default_path()
    schema = encoded.select(F.struct("*").alias("row")).schema.add("decoded", "string")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tok = load(path)
        for b in batches:
            out = [tok.decode(np.array(i or [], dtype="<u4").tobytes()) for i in b.column(0).field(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, type=pa.string())], names=["row", "decoded"])

    return encoded.select(F.struct("*").alias("row")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """Encode whole texts, decode what was encoded, and digest both, in one pass over batches.

    Returns the id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and the ids
    themselves if asked for. Null and empty texts have no tokens.
    """
    path = path or default_path()
    kind = docs.schema[id_col].dataType.simpleString()
    shape = "i " + kind + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = load(path)
        for b in batches:
            for at in range(0, len(b), 512):        # bounded output batches
                rows = []
                for t in b["t"].iloc[at:at + 512]:
                    ids = tok.encode(t)
                    text = tok.decode(ids).encode("utf-8", "surrogatepass")
                    row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest())
                    rows.append(row + (np.frombuffer(ids, dtype="<i4"),) * with_ids)
                out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)
                out.insert(0, "i", b["i"].iloc[at:at + 512].to_numpy())
                yield out

    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInPandas(run, shape).withColumnRenamed("i", id_col))

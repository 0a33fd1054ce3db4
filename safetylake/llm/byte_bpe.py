"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string BPE ends in one token, and a sequence of
tokens is what BPE makes of its bytes exactly if each two neighbours are what
BPE makes of theirs. So the last token of a prefix is the one suffix of it that
fits the last token of what stands before: a table of one token a byte, filled
from left to right. The encoding is read off the table backwards.

The table makes changes cheap. Appending bytes only adds entries, and every
prefix's encoding stays at hand. After an edit the entries from there on are
computed again until as many in a row as the longest token has bytes agree
with the old table; from then on all of them do.

Texts are split by a pattern first, and a match that is a token as a whole is
that token, as in the library whose rank files are read. Executors read the rank
file by its installed path (a parameter).
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

#: Entries a worker keeps of known pieces and of known pairs; beyond it a cache starts anew.
KNOWN_PIECES = 800_000
KNOWN_PAIRS = 2_000_000
#: Bytes of the pieces whose tables are filled together.
AT_ONCE = 32
#: Characters past its end that decide where a match of the splitting pattern ends.
AHEAD = 2


NEVER = 1 << 40


class Ranks:
    """A vocabulary of byte strings with their merge ranks, which are the ids."""

    def __init__(self, tokens: dict[bytes, int]):
        import ahocorasick

        self.id = tokens
        self.bytes = {i: t for t, i in tokens.items()}
        self.longest = max(map(len, tokens), default=1)
        self.pairs: dict[tuple[int, int], bool] = {}
        # Finds the tokens that end at each byte. What no merges lead to never stands in a longer string.
        self.ends = ahocorasick.Automaton()
        self.halves: dict[int, tuple[int, int]] = {}        # token -> what its last merge joins
        for t, i in tokens.items():
            parts = self.merged(t, least=2)
            if len(t) == 1 or len(parts) == 2:
                self.ends.add_word(t.decode("latin-1"), (len(t), i))
                if len(t) > 1:
                    self.halves[i] = parts[0], parts[1]
        self.ends.make_automaton()
        # a token's parts are merged before it, so its edges grow in the order of ranks
        self.ordered = all(len(self.bytes[h]) == 1 or h < i for i, both in self.halves.items() for h in both)
        self.edges: tuple[dict, dict] = ({}, {})

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """BPE by its definition, down to ``least`` parts: merge the pair of least rank, the leftmost of equals."""
        parts, get = [data[i:i + 1] for i in range(len(data))], self.id.get
        while len(parts) > least:
            rank, at = min((get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.id[p] for p in parts]

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one end of a token while it is merged, each with the rank of the merge that ends it."""
        got = self.edges[side].get(token)
        if got is None:
            parts = [token]
            while parts[-1] in self.halves:
                parts.append(self.halves[parts[-1]][side])
            parts.reverse()
            got = self.edges[side][token] = list(zip([self.bytes[p] for p in parts], [*parts[1:], NEVER]))
        return got

    def fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves the bytes of the two tokens as these two tokens.

        The parts at the seam are followed in the order of ranks: a merge across
        it must not come before the merges that take its parts away. Of equal ranks the left one is first.
        """
        if not self.ordered:
            return self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
        ours, theirs, get = iter(self._edge(left, 1)), iter(self._edge(right, 0)), self.id.get
        a, a_ends = next(ours)
        b, b_ends = next(theirs)
        while True:
            across = get(a + b, NEVER)
            if across < a_ends and across <= b_ends and across != NEVER:
                return False
            if a_ends <= b_ends:
                if a_ends == NEVER:
                    return True
                a, a_ends = next(ours)
            else:
                b, b_ends = next(theirs)

    def trie(self) -> tuple[np.ndarray, np.ndarray]:
        """``(next, token)``: the node after a node (0: none, 1: no bytes yet) and a byte, and the token a node spells (-1: none)."""
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for data, (_, token) in self.ends.items():
            at = 1
            for b in data.encode("latin-1"):
                at = nodes.setdefault((at, b), len(nodes) + 2)
            ends[at] = token
        follow, token = np.zeros((len(nodes) + 2, 256), dtype=np.int32), np.full(len(nodes) + 2, -1, dtype=np.int32)
        for (at, b), to in nodes.items():
            follow[at, b] = to
        token[list(ends)] = list(ends.values())
        return follow, token

    def fit(self, left: int, right: int) -> bool:
        """The same, remembered."""
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        known = self.pairs[left, right] = self.fits(left, right)
        return known


class Prefixes:
    """The last token of every prefix of ``data``: ``last[i]`` ends the encoding of ``data[:i]``."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, bytearray(), [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self._fill(start)

    def _fill(self, start: int, old: list[int] | None = None, tail: int = 0) -> int:
        """Entries after ``start``; stops early where those of the last ``tail`` bytes agree with ``old``. The number computed."""
        data, last, ranks = self.data, self.last, self.ranks
        known, fit = ranks.pairs.get, ranks.fit
        skip = max(0, start - ranks.longest)
        agreed, at = 0, start - skip            # the byte whose token is looked for
        for here, (size, token) in ranks.ends.iter(data[skip:].decode("latin-1")):      # by end, the longest first
            if here != at:
                continue
            begin = here + 1 - size + skip
            if begin:
                before = last[begin]
                fits = known((before, token))
                if fits is None:
                    fits = fit(before, token)
                if not fits:
                    continue
            last.append(token)
            at += 1
            if old is not None:
                behind = at + skip - (len(data) - tail) - 1       # this entry's place in the old tail
                agreed = agreed + 1 if behind >= 0 and token == old[behind] else 0
                if agreed == ranks.longest:
                    last.extend(old[behind + 1:])
                    return at + skip - start
        if len(last) != len(data) + 1:
            raise ValueError(f"no token ends at byte {len(last)}")
        return len(data) - start

    def ids(self, end: int | None = None) -> list[int]:
        """Encoding of the first ``end`` bytes, all by default."""
        out, sizes = [], self.ranks.bytes
        end = len(self.data) if end is None else end
        while end:
            out.append(self.last[end])
            end -= len(sizes[out[-1]])
        return out[::-1]

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace ``data[start:stop]``; the number of entries computed anew."""
        tail, old = len(self.data) - stop, self.last[stop + 1:]
        self.data[start:stop] = new
        del self.last[start + 1:]
        return self._fill(start, old, tail)


class Tables:
    """Prefix tables of many short byte strings at once: the same entries as ``Prefixes``, a column of bytes at a time."""

    SLOTS = 1 << 20

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.next, self.token = ranks.trie()
        # answers of ``fits``, each at the place its pair hashes to; a later pair may take it
        self.pair, self.answer = np.full(self.SLOTS, -1, dtype=np.int64), np.zeros(self.SLOTS, dtype=bool)

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = (left.astype(np.int64) << 32) | right
        slots = ((pairs ^ (pairs >> 15)) * 0x9E3779B1 >> 7) & (self.SLOTS - 1)
        out, known = self.answer[slots], self.pair[slots] == pairs
        if not known.all():
            new, where = np.unique(pairs[~known], return_inverse=True)
            answers = np.array([self.ranks.fits(int(p >> 32), int(p & 0xFFFFFFFF)) for p in new], dtype=bool)
            out[~known] = answers[where]
            self.pair[slots[~known]], self.answer[slots[~known]] = pairs[~known], answers[where]
        return out

    def last(self, strings: list[bytes]) -> np.ndarray:
        """Row ``i``, column ``j``: the token that ends the encoding of the first ``j`` bytes of string ``i``."""
        sizes = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        width = int(sizes.max(initial=0))
        data = np.frombuffer(b"".join([t.ljust(width, b"\0") for t in strings]), dtype=np.uint8).reshape(-1, width)
        last = np.full((len(strings), width + 1), -1, dtype=np.int32)
        nodes = np.empty((width, len(strings)), dtype=np.int32)         # by start: where the bytes since then lead
        for end in range(1, width + 1):
            byte = data[:, end - 1]
            nodes[end - 1] = 1
            open_ = np.flatnonzero(sizes >= end)
            for start in range(max(0, end - self.ranks.longest), end):     # the longest first
                nodes[start] = self.next[nodes[start], byte]
                token = self.token[nodes[start, open_]]
                some = np.flatnonzero(token >= 0)
                if start and some.size:
                    some = some[self._fits(last[open_[some], start], token[some])]
                if some.size:
                    last[open_[some], end] = token[some]
                    rest = np.ones(open_.size, dtype=bool)
                    rest[some] = False
                    open_ = open_[rest]
            if open_.size:
                raise ValueError(f"no token ends at byte {end}")
        return last

    def ids(self, strings: list[bytes]) -> list[list[int]]:
        sizes, out = self.ranks.bytes, []
        for t, row in zip(strings, self.last(strings).tolist()):
            end, ids = len(t), []
            while end:
                ids.append(row[end])
                end -= len(sizes[row[end]])
            out.append(ids[::-1])
        return out


class Encoder:
    """Splitting, encoding and decoding with one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = Ranks({base64.b64decode(t): int(i) for t, i in map(bytes.split, f)})
        self.tables = Tables(self.ranks)
        # white space as Unicode has it; the module's own class has four control characters more
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.known: dict[str, tuple[str, bytes]] = {}       # piece -> (ids in decimal, ids as 32-bit integers)

    def _learn(self, pieces: set[str]) -> dict[str, tuple[str, bytes]]:
        """What ``pieces`` encode to; the short ones by tables of many at once, in order of length so that rows are filled."""
        found: dict[str, list[int]] = {}
        short: list[tuple[int, bytes, str]] = []
        for p in pieces:
            data = p.encode()
            if data in self.ranks.id:
                found[p] = [self.ranks.id[data]]
            elif len(data) > AT_ONCE:
                found[p] = Prefixes(self.ranks, data).ids()
            else:
                short.append((len(data), data, p))
        if len(short) < 64:         # too few to be worth columns
            found |= {p: Prefixes(self.ranks, data).ids() for _, data, p in short}
            short = []
        short.sort()
        for at in range(0, len(short), 4096):
            part = short[at:at + 4096]
            found |= zip([p for _, _, p in part], self.tables.ids([d for _, d, _ in part]))
        return {p: (",".join(map(str, ids)), array("i", ids).tobytes()) for p, ids in found.items()}

    def encode_all(self, texts: list[str | None]) -> list[tuple[str, bytes]]:
        """Ids of each text in decimal, joined by commas, and as little-endian 32-bit integers; null is empty."""
        split = [self.split.findall(t) if t else [] for t in texts]
        pieces = set().union(*split)
        new = {p for p in pieces if p not in self.known}
        if len(self.known) + len(new) > KNOWN_PIECES:
            self.known.clear()
            new = pieces
        known = self._learn(new)
        if len(new) <= KNOWN_PIECES:
            self.known |= known
            known = self.known
        out = []
        for parts in split:
            made = [known[p] for p in parts]
            out.append((",".join([m[0] for m in made]), b"".join([m[1] for m in made])))
        if known is self.known:
            for p in [p for p in new if len(p) > 64]:
                del known[p]            # long ones seldom come again
        return out

    def encode(self, text: str | None) -> tuple[str, bytes]:
        return self.encode_all([text])[0]

    def batches(self, texts: list[str | None], size: int = 1 << 21) -> Iterator[list[tuple[str, bytes]]]:
        """``encode_all`` over runs of texts with about ``size`` characters, so that working space stays bounded."""
        part, held = [], 0
        for t in texts:
            part.append(t)
            held += len(t or "")
            if held >= size:
                yield self.encode_all(part)
                part, held = [], 0
        if part:
            yield self.encode_all(part)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.bytes.__getitem__, np.frombuffer(ids, dtype="<i4").tolist()))


class EditedText:
    """A text with its encoding, kept exact through appends and edits."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.starts: list[int] = []
        self.pieces: list[Prefixes] = []
        self.edit(0, 0, text)

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replace ``text[start:stop]``; the number of byte prefixes computed anew.

        Matches that end ``AHEAD`` characters before the edit stay. Splitting goes
        on from there until a match after the edit starts where one did before.
        """
        text = self.text[:start] + new + self.text[stop:]
        shift = len(new) - (stop - start)
        ends = [*self.starts[1:], len(self.text)] if self.starts else []
        keep = 0
        while keep < len(ends) and ends[keep] + AHEAD <= start:
            keep += 1
        at = ends[keep - 1] if keep else 0
        old = {s: i for i, s in enumerate(self.starts) if s >= stop}
        starts, pieces, done, rest = self.starts[:keep], self.pieces[:keep], 0, len(self.starts)
        for m in self.encoder.split.finditer(text, at):
            i = old.get(m.start() - shift)
            if i is not None and m.start() >= start + len(new):
                rest = i
                break
            starts.append(m.start())
            table, cost = self._table(m, start, stop, new)
            pieces.append(table)
            done += cost
        self.pieces = pieces + self.pieces[rest:]
        self.starts = starts + [s + shift for s in self.starts[rest:]]
        self.text = text
        return done

    def _table(self, m, start: int, stop: int, new: str) -> tuple[Prefixes, int]:
        """The table of one match: the old one, changed, where a piece began there and holds the whole edit."""
        piece = m.group()
        try:
            i = self.starts.index(m.start())
        except ValueError:
            i = None
        if i is not None and self.starts[i] <= start:
            was = self.pieces[i].data.decode()
            lo, hi = start - m.start(), stop - m.start()
            if hi <= len(was) and was[:lo] + new + was[hi:] == piece:
                table = self.pieces[i]
                return table, table.edit(len(was[:lo].encode()), len(was[:hi].encode()), new.encode())
        data = piece.encode()
        return Prefixes(self.encoder.ranks, data), len(data)

    def ids(self) -> list[int]:
        whole = self.encoder.ranks.id
        out: list[int] = []
        for p in self.pieces:
            one = whole.get(bytes(p.data))
            out += p.ids() if one is None else [one]
        return out


_LOADED: dict[tuple[str, str], Encoder] = {}


def load(path: str, pattern: str) -> Encoder:
    """One encoder per worker process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Encoder(path, pattern)
        gc.freeze()         # the tables stay as long as the worker; the collector need not walk them
    return _LOADED[path, pattern]


def defaults() -> tuple[str, str]:
    """Rank file and splitting pattern of the installed vocabulary for many languages."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, files: tuple[str, str] | None = None, text_col: str = "text") -> DataFrame:
    """``row`` (all columns), ``ids`` (array<int>): one row per row.

    Null and empty texts have no ids. Columns of any name may be present.
    """
    files = files or defaults()
    schema = docs.select(F.struct("*").alias("row")).schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = load(*files)
        for b in batches:
            texts = b.column(0).field(text_col).to_pylist()
            at = 0
            for part in enc.batches(texts):
                ids = [np.frombuffer(i, dtype="<i4") for _, i in part]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(part)), pa.array(ids, type=pa.list_(pa.int32()))], names=["row", "ids"])
                at += len(part)

    return docs.select(F.struct("*").alias("row")).mapInArrow(run, schema)


def decode(encoded: DataFrame, files: tuple[str, str] | None = None, ids_col: str = "ids") -> DataFrame:
    """The input's columns as ``row`` and ``decoded`` (bytes, as ids may cut a character); null ids decode to nothing."""
    files = files or defaults()
    schema = encoded.select(F.struct("*").alias("row")).schema.add("decoded", "binary")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = load(*files)
        for b in batches:
            out = [enc.decode(np.array(i or [], dtype="<i4").tobytes()) for i in b.column(0).field(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, type=pa.binary())], names=["row", "decoded"])

    return encoded.select(F.struct("*").alias("row")).mapInArrow(run, schema)


def edited(docs: DataFrame, start: str, stop: str, new: str, files: tuple[str, str] | None = None,
           text_col: str = "text") -> DataFrame:
    """Each row's text with the characters ``start`` to ``stop`` replaced by ``new`` (names of columns), encoded
    before and near the edit again: ``row``, ``text``, ``ids``, ``n_anew`` (byte prefixes computed for the edit).

    Nulls: a null text is empty, a null replacement is empty, a null bound is the end of the text (an append);
    bounds are held to the text.
    """
    files = files or defaults()
    kept = docs.select(F.struct("*").alias("row"))
    schema = StructType([*kept.schema.fields, StructField("text", StringType()),
                         StructField("ids", ArrayType(IntegerType())), StructField("n_anew", LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = load(*files)
        for b in batches:
            row = b.column(0)
            columns = [row.field(c).to_pylist() for c in (text_col, start, stop, new)]
            texts, ids, anew = [], [], []
            for t, lo, hi, put in zip(*columns):
                t = t or ""
                lo = len(t) if lo is None else max(0, min(lo, len(t)))
                hi = len(t) if hi is None else max(lo, min(hi, len(t)))
                table = EditedText(enc, t)
                anew.append(table.edit(lo, hi, put or ""))
                texts.append(table.text)
                ids.append(table.ids())
            yield pa.RecordBatch.from_arrays([row, pa.array(texts, pa.string()), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(anew, pa.int64())], names=["row", "text", "ids", "n_anew"])

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, files: tuple[str, str] | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode whole texts, decode what was encoded, and digest both, in one pass over batches.

    Returns the id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``. Null and empty texts have no tokens;
    repeated rows and null ids give a row each.
    """
    files = files or defaults()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = load(*files)
        for b in batches:
            rows = []
            for part in enc.batches(b["t"].tolist()):
                rows += [(len(ids) // 4, hashlib.sha256(shown.encode()).hexdigest(),
                          hashlib.sha256(enc.decode(ids)).hexdigest()) for shown, ids in part]
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "i", b["i"].array)
            yield out

    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInPandas(run, f"i {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("i", id_col))

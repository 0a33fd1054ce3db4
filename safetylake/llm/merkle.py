"""A Merkle manifest of a dataset: one digest for all rows and a proof for each row.

Leaves of a source are ordered by id and every run of three nodes gets a parent
until one node, the source's subroot, remains; the subroots, ordered by source,
are the leaves of one more such tree, whose last node is the root.

Digests move by time-forward processing. A node's label is (level, index), so
children always come before their parents. A finished node sends its digest to
its parent as a message labelled with the parent; the queue gives messages out
in label order, so all children of a node arrive together when its turn comes.
A second sweep takes the labels in reverse and sends each child the part of its
proof above it.

The queue is external: a tree is cut into blocks of 3^6 neighbouring nodes,
whose messages fit a task's heap; messages that leave a block are rows in the
shared folder, which the shuffle delivers by (tree, block) label to the block
above. A tree of n rows takes log(n) / log(729) such layers whatever its
sources, and no task ever holds more than one block.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import staged
from .ranking import ranked

#: Children of a node, and levels climbed inside one task (a block of 3^6 nodes).
WIDTH = 3
LEVELS = 6

#: Columns of a leaf, in the order they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: list[Column]) -> Column:
    """Hex digest of the values, each as byte count, ``:``, value; ``-`` for a null."""
    parts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-"))
                             for p in parts]), 256)


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n = -(-n // WIDTH)
        levels += 1
    return levels


def climb(digests: list[str], levels: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """Forward sweep: the node ``levels`` above the digests, and each parent's run of children."""
    if not levels:
        return digests[0], {}
    queue = [(1, i // WIDTH, i % WIDTH, d) for i, d in enumerate(digests)]      # in label order: a heap
    runs: dict[tuple[int, int], list[str]] = {}
    while True:
        label = queue[0][:2]
        run = []
        while queue and queue[0][:2] == label:
            run.append(heapq.heappop(queue)[3])
        runs[label] = run
        level, index = label
        digest = sha256("".join(run).encode()).hexdigest()
        if level == levels:
            return digest, runs
        heapq.heappush(queue, (level + 1, index // WIDTH, index % WIDTH, digest))


def descend(runs: dict[tuple[int, int], list[str]], levels: int, above: tuple[list[str], list[str]]) -> list[tuple[list[str], list[str]]]:
    """Reversed sweep: for each node at the bottom its siblings to the left and right, level by level to the root."""
    if not levels:
        return [above]
    out: dict[int, tuple[list[str], list[str]]] = {}
    queue = [(-levels, 0, above)]
    while queue:
        level, index, (left, right) = heapq.heappop(queue)
        level, index = -level, -index
        run = runs[level, index]
        for place in range(len(run)):
            child = index * WIDTH + place
            proof = (["".join(run[:place]), *left], ["".join(run[place + 1:]), *right])
            if level == 1:
                out[child] = proof
            else:
                heapq.heappush(queue, (1 - level, -child, proof))
    return [out[i] for i in range(len(out))]


def _levels(block: int, n: int, levels: int) -> int:
    # Only the last block of a tree is not full, and a first block that is not full is the whole tree.
    return levels if block else height(n)


def _block(levels: int) -> Column:
    return F.floor(F.col("_rank") / WIDTH ** levels).cast("bigint").alias("_block")


def climbed(layer: DataFrame, label: str, levels: int = LEVELS) -> list[DataFrame]:
    """The layers of every tree: nodes ``(_tree, _rank, digest)`` of one layer, then the tops of their
    blocks, and so on until each tree has one node."""
    def tops(table):
        import pyarrow as pa

        table = table.sort_by("_rank")
        block = table["_block"][0].as_py()
        top, _ = climb([d.hex() for d in table["digest"].to_pylist()], _levels(block, table.num_rows, levels))
        return pa.table({"_tree": table["_tree"][:1], "_rank": pa.array([block], pa.int64()),
                         "digest": pa.array([bytes.fromhex(top)], pa.binary())})

    kind = layer.schema["_tree"].dataType.simpleString()
    layers = [layer]
    while True:
        nodes = layers[-1].select("_tree", "_rank", "digest", _block(levels))
        above = staged(nodes.groupBy("_tree", "_block").applyInArrow(tops, f"_tree {kind}, _rank bigint, digest binary"),
                       f"{label}-{len(layers)}")
        layers.append(above)
        if not above.agg(F.max("_rank")).first()[0]:
            return layers


def _sender(names: list[str], more: list[str], most: int):
    """The reversed sweep of one block: its nodes and the message to its top in, its nodes with proofs out."""
    def proofs(table, message):
        import pyarrow as pa

        if not (table.num_rows and message.num_rows):       # every block has one message, and the other way round
            raise ValueError("a block and its message do not meet")
        table = table.sort_by("_rank")
        n, levels = table.num_rows, _levels(table["_block"][0].as_py(), table.num_rows, most)
        _, runs = climb([d.hex() for d in table["digest"].to_pylist()], levels)
        left, right = zip(*descend(runs, levels, (message["left"][0].as_py(), message["right"][0].as_py())))
        made = {"left": pa.array(left, pa.list_(pa.string())), "right": pa.array(right, pa.list_(pa.string()))}
        for c in more:
            if c not in made:
                made[c] = pa.array([message[c][0].as_py()] * n, message.schema.field(c).type)
        return pa.table({c: table[c] for c in names} | {c: made[c] for c in more})

    return proofs


def descended(layers: list[DataFrame], messages: DataFrame, label: str, levels: int = LEVELS) -> DataFrame:
    """The first layer's rows with ``left`` and ``right``, their siblings level by level, given the
    messages ``(_tree, _rank, left, right, ...)`` to the last layer. Further columns of the messages go along."""
    more = [c for c in messages.columns if c not in ("_tree", "_rank")]
    for depth in range(len(layers) - 2, -1, -1):
        layer = layers[depth]
        shape = StructType([*layer.schema.fields, *[messages.schema[c] for c in more]])
        out = (layer.select("*", _block(levels)).groupBy("_tree", "_block")
               .cogroup(messages.withColumnRenamed("_rank", "_block").groupBy("_tree", "_block"))
               .applyInArrow(_sender(layer.columns, more, levels), shape))
        if not depth:
            return out
        messages = staged(out.select("_tree", "_rank", *more), f"{label}-down-{depth}")
    raise ValueError("no layers")


def manifest(leaves: DataFrame, source_col: str = "source", id_col: str = "doc_id", leaf_col: str = "leaf",
             levels: int = LEVELS) -> DataFrame:
    """The rows of ``leaves`` with ``subroot``, ``root`` and the proof (``left``, ``right``: arrays of hex text).

    ``leaves`` holds hex digests in ``leaf_col``; its other columns stay as they are, whatever their
    names. Nulls: a null source is a source of its own and comes first, null ids come first in their
    source. Rows with one id are ordered by their digest, so repeated rows give one result. No rows give
    no rows.
    """
    others = [c for c in leaves.columns if c != leaf_col]
    base = leaves.select(F.col(source_col).alias("_tree"), F.col(id_col).alias("_id"),
                         F.unhex(leaf_col).alias("digest"), F.struct(*others).alias("row"))
    base = ranked(staged(base, "merkle-leaves"), ["_tree"], ["_id", "digest"], "merkle-order").drop("_id")
    layers = climbed(staged(base, "merkle-0"), "merkle", levels)

    subroots = ranked(layers[-1].select(F.col("_tree").alias("source"), "digest"), [], ["source"], "merkle-sources")
    upper = climbed(staged(subroots.withColumn("_tree", F.lit(0)), "merkle-top-0"), "merkle-top", levels)
    none = F.array().cast("array<string>")
    start = upper[-1].select("_tree", "_rank", none.alias("left"), none.alias("right"), F.hex("digest").alias("root"))
    heads = staged(descended(upper, start, "merkle-top", levels).select(
        F.col("source").alias("_tree"), F.lit(0).cast("bigint").alias("_rank"), "left", "right",
        F.lower(F.hex("digest")).alias("subroot"), F.lower("root").alias("root")), "merkle-heads")
    return descended(layers, heads, "merkle", levels).select(
        "row.*", F.lower(F.hex("digest")).alias(leaf_col), "subroot", "root", "left", "right")


def folded(digest: Column, left: Column, right: Column) -> Column:
    """The root that a leaf digest and a proof lead to."""
    return F.aggregate(F.arrays_zip(left.alias("l"), right.alias("r")), digest,
                       lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]), 256))


def proof_digest(left: Column, right: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda l, r: F.concat(l, r)), ""), 256)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, text_col: str = "text") -> DataFrame:
    """Id, source and leaf digest of each document, and its digest after tampering: every second
    document (by the CRC-32 of its id) loses the line ends of its text. Null ids are not tampered with."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.replace(F.col(text_col), F.lit("\n"), F.lit(""))
    tampered = F.when(chosen & F.contains(F.col(text_col), F.lit("\n")),
                      leaf([cut if f == text_col else F.col(f) for f in fields]))
    return docs.select("doc_id", "source", leaf([F.col(f) for f in fields]).alias("leaf"), F.unhex(tampered).alias("tampered"))


def report(proven: DataFrame) -> DataFrame:
    """Digest columns of ``manifest(leaves(docs))``: the proof's digest and what the tampered leaf folds to."""
    now = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    return (proven.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("left"), F.col("right")).alias("proof_sha256"),
                          folded(now, F.col("left"), F.col("right")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


ORACLE = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS uid, doc_id, source, text,
         list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
           lambda crc, b: list_reduce([xor(crc, b)] || [0::BIGINT for z in range(8)],
             lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))) AS crc,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents),
texts AS (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM docs),
leaves AS (
  SELECT uid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) AS tampered
  FROM texts),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
up AS (
  SELECT source, 0 AS lvl, i, leaf AS h, n FROM placed
  UNION ALL
  SELECT source, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM up WHERE n > 1 GROUP BY source, lvl, i // 3, n),
subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, i, h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY lvl, i // 3, n),
walk AS (
  SELECT uid, source, 0 AS lvl, i, n FROM placed
  UNION ALL
  SELECT uid, source, lvl + 1, i // 3, (n + 2) // 3 FROM walk WHERE n > 1),
high AS (
  SELECT p.uid, 0 AS lvl, s.i, s.n FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT uid, lvl + 1, i // 3, (n + 2) // 3 FROM high WHERE n > 1),
steps AS (
  SELECT w.uid, w.lvl AS k, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < w.i), '') AS l,
         coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > w.i), '') AS r
  FROM walk w JOIN up u ON u.source IS NOT DISTINCT FROM w.source AND u.lvl = w.lvl AND u.i // 3 = w.i // 3
  WHERE w.n > 1 GROUP BY w.uid, w.lvl
  UNION ALL
  SELECT w.uid, 1000 + w.lvl, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < w.i), ''),
         coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > w.i), '')
  FROM high w JOIN top u ON u.lvl = w.lvl AND u.i // 3 = w.i // 3
  WHERE w.n > 1 GROUP BY w.uid, w.lvl),
path AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY k) AS step FROM steps),
fold AS (
  SELECT uid, 0::BIGINT AS step, tampered AS h FROM placed
  UNION ALL
  SELECT f.uid, p.step, sha256(p.l || f.h || p.r) FROM fold f JOIN path p ON p.uid = f.uid AND p.step = f.step + 1),
proofs AS (SELECT uid, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM path GROUP BY uid),
folds AS (SELECT uid, arg_max(h, step) AS folded_root FROM fold GROUP BY uid),
root AS (SELECT h FROM top WHERE n = 1)
SELECT p.doc_id, p.leaf, s.h AS subroot, root.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       f.folded_root, f.folded_root = root.h AS verified
FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
JOIN folds f USING (uid) LEFT JOIN proofs q USING (uid) CROSS JOIN root
"""

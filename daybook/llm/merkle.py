"""A Merkle manifest of a table: one root over all rows, and a proof per row.

Rows are leaves of a tree per language, and the roots of these trees are leaves of one more tree. Every
node is the hash of up to eight below it. A tree is cut into blocks, aligned subtrees of
``BLOCK_LEVELS`` levels: a task builds a block from its leaves, the block roots are the leaves of the
next blocks, and so on, which needs no more steps than the tree has levels of blocks.

A block is stored as one array in van Emde Boas order: the tree is split at half its height, the
upper half comes first and then each subtree below it, each laid out the same way. So nodes that are
near in the tree are near in the array at every scale, and where a node stands is plain arithmetic of its
depth and index; building a block and reading the siblings of a leaf use the same addresses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.session import checkpointed

FAN = 8
BLOCK_LEVELS = 4  # 4,096 leaves a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HASH_BYTES = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before: string, after: string>>"


# --- layout ---


def nodes_in(levels: int) -> int:
    """Nodes of a whole tree with so many levels of nodes."""
    return (FAN**levels - 1) // (FAN - 1)


def places(levels: int) -> tuple[np.ndarray, ...]:
    """Place in the array of each node, per depth from the root, of a tree with so many levels of nodes."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    upper = levels // 2
    lower = places(levels - upper)
    starts = nodes_in(upper) + nodes_in(levels - upper) * np.arange(FAN**upper)
    return *places(upper), *((starts[:, None] + depth[None, :]).ravel() for depth in lower)


def hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def build(leaves: list[str], height: int) -> bytes:
    """The block of a tree of ``height`` levels of hashing above its leaves, in its stored order."""
    at = places(height + 1)
    stored = np.zeros((nodes_in(height + 1), HASH_BYTES), np.uint8)
    nodes = leaves
    for depth in range(height, -1, -1):
        raw = np.frombuffer(bytes.fromhex("".join(nodes)), np.uint8).reshape(-1, HASH_BYTES)
        stored[at[depth][: len(nodes)]] = raw
        if depth:
            nodes = [hashed("".join(nodes[k : k + FAN])) for k in range(0, len(nodes), FAN)]
    return stored.tobytes()


class Block:
    """A stored block of so many leaves, for reading."""

    def __init__(self, stored: bytes, height: int, leaves: int) -> None:
        self.nodes = np.frombuffer(stored, np.uint8).reshape(-1, HASH_BYTES)
        self.height, self.leaves, self.at = height, leaves, places(height + 1)
        self.runs: dict[tuple[int, int], str] = {}

    def run(self, depth: int, parent: int) -> str:
        """The nodes below the ``parent``-th node of the depth above, as text."""
        if (depth, parent) not in self.runs:
            across = FAN ** (self.height - depth)
            some = self.at[depth][parent * FAN : min(parent * FAN + FAN, -(-self.leaves // across))]
            self.runs[depth, parent] = self.nodes[some].tobytes().hex()
        return self.runs[depth, parent]

    def path(self, leaf: int) -> list[tuple[str, str]]:
        """What stands before and after the nodes from a leaf to below the root, as texts."""
        found, node = [], leaf
        for depth in range(self.height, 0, -1):
            run, child = self.run(depth, node // FAN), node % FAN * 2 * HASH_BYTES
            found.append((run[:child], run[child + 2 * HASH_BYTES :]))
            node //= FAN
        return found


def folded(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in path:
        leaf = hashed(before + leaf + after)
    return leaf


# --- leaves ---


def _written(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, ``tree`` (the language, also NULL, as text), leaf and the leaf when tampered with.

    A row is tampered with when 3 divides the crc32 of its decimal doc_id: A-Z of its text become a-z.
    A row without doc_id is not.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    fields = {name: _written(F.col(name)) for name in FIELDS} | {"doc_id": _written(doc_id)}
    leaf = F.sha2(F.concat(*[fields[name] for name in FIELDS]), 256)
    other = fields | {"text": _written(F.translate(text, _UPPER, _LOWER))}
    hit = F.crc32(doc_id.cast("string")) % 3 == 0
    tampered = F.when(hit, F.sha2(F.concat(*[other[name] for name in FIELDS]), 256)).otherwise(leaf)
    lang = F.col("lang").cast("string")
    return docs.select(
        doc_id.alias("doc_id"), lang.alias("lang"), _written(lang).alias("tree"), leaf.alias("leaf"), tampered.alias("given")
    )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with ``position`` within their ``tree`` in the given order, from 0, and ``size`` of the tree.

    Rows are dealt by range of tree and order, so a tree with most of the rows is many tasks' work; a
    row's position is its place in its range and the number of rows of its tree in ranges before.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = checkpointed(ranged.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33).alias("__part")
    parts = ranged.groupBy(part, "tree").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy("tree")
    before = F.sum("__n").over(whole.orderBy("__part")) - F.col("__n")
    parts = parts.withColumns({"__before": before, "size": F.sum("__n").over(whole)}).drop("__n")
    joined = ranged.withColumn("__part", part).join(parts, ["__part", "tree"])
    position = F.col("__at") - F.col("__first") + F.col("__before")
    return joined.withColumn("position", position).drop("__part", "__at", "__first", "__before")


# --- trees ---


def _height(size: int, levels: int) -> int:
    """Levels of hashing of a block in a tree with ``size`` nodes at the block's leaves."""
    if size > FAN**levels:
        return levels
    height = 0
    while FAN**height < size:
        height += 1
    return height


def blocks(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """tree, block, size, leaves, stored and root of each block over nodes (tree, position, size, node)."""

    def make(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("position")
        size = rows["size"][0].as_py()
        stored = build(rows["node"].to_pylist(), _height(size, levels))
        one = {
            "tree": rows["tree"][:1],
            "block": rows["block"][:1],
            "size": [size],
            "leaves": pa.array([len(rows)], pa.int32()),
            "stored": pa.array([stored], pa.binary()),
            "root": [stored[:HASH_BYTES].hex()],
        }
        return pa.table(one)

    dealt = nodes.select("tree", _block(levels), "position", "size", "node")
    made = dealt.groupBy("tree", "block").applyInArrow(
        make, "tree string, block long, size long, leaves int, stored binary, root string"
    )
    return checkpointed(made)


def _block(levels: int) -> Column:
    return F.floor(F.col("position") / FAN**levels).cast("long").alias("block")


def forest(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """The blocks of all trees, from those over the leaves up; the last ones hold the roots of the largest.

    A tree whose nodes fit into one block ends there.
    """
    floors = []
    while True:
        floors.append(blocks(nodes, levels))
        more = floors[-1].filter(F.col("size") > FAN**levels)
        if more.isEmpty():
            return floors
        size = F.ceil(F.col("size") / FAN**levels).cast("long").alias("size")
        nodes = more.select("tree", F.col("block").alias("position"), size, F.col("root").alias("node"))


def roots(floors: list[DataFrame], levels: int = BLOCK_LEVELS) -> DataFrame:
    """tree and subroot of every tree."""
    ends = [floor.filter(F.col("size") <= FAN**levels) for floor in floors]
    found = [end.select("tree", F.col("root").alias("subroot")) for end in ends]
    return _union(found)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _below(floor: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """tree, block and path of the leaves of a floor's blocks, which are the blocks of the floor below."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["stored"], _height(row["size"], levels), row["leaves"])
                upper = [(step["before"], step["after"]) for step in row["path"]]
                first = row["block"] * FAN**levels
                for leaf in range(row["leaves"]):
                    path = [{"before": b, "after": a} for b, a in block.path(leaf) + upper]
                    out = {"tree": row["tree"], "block": first + leaf, "path": path, "subroot": row["subroot"]}
                    yield pa.RecordBatch.from_pylist([out], _path_type())

    joined = floor.join(above, ["tree", "block"])
    columns = ["tree", "block", "size", "leaves", "stored", "path", "subroot"]
    return joined.select(*columns).mapInArrow(read, f"tree string, block long, path {_PATH}, subroot string")


def _path_type() -> pa.Schema:
    step = pa.struct([("before", pa.string()), ("after", pa.string())])
    return pa.schema([("tree", pa.string()), ("block", pa.int64()), ("path", pa.list_(step)), ("subroot", pa.string())])


def block_paths(floors: list[DataFrame], tops: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """tree, block, path to the very root, and subroot of each block of the lowest floor.

    ``tops`` has tree, path and subroot: what lies above the root of each tree.
    """
    above = None
    for floor in reversed(floors):
        ends = floor.filter(F.col("size") <= FAN**levels).select("tree", "block")
        here = ends.join(tops, "tree").select("tree", "block", "path", "subroot")
        if above is not None:
            here = here.unionByName(above)
        if floor is floors[0]:
            return here
        above = checkpointed(_below(floor, here, levels))
    raise ValueError("no floors")


def manifest(docs: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of docs.

    Leaves of a language stand by doc_id, rows without one first, equal ids by their leaf; languages
    stand by their bytes, NULL first. ``folded_root`` is what the leaf, of the text tampered with where it is,
    and its siblings lead to. Rows that are alike in all fields are leaves of their own. An empty table gives
    no rows; columns other than those of documents are left out.
    """
    rows = placed(checkpointed(leaves(docs)), ["doc_id", "leaf"])
    rows = checkpointed(rows)
    floors = forest(rows.select("tree", "position", "size", F.col("leaf").alias("node")), levels)
    found = roots(floors, levels)

    langs = rows.filter("position = 0").select("lang", "tree").join(found, "tree")
    langs = langs.select(F.lit("").alias("tree"), "lang", F.col("tree").alias("of"), "subroot")
    langs = checkpointed(placed(checkpointed(langs), ["lang"]))
    upper = forest(langs.select("tree", "position", "size", F.col("subroot").alias("node")), levels)
    none = F.expr(f"cast(array() as {_PATH})").alias("path")
    ends = upper[-1].select("tree", none, F.col("root").alias("subroot"))
    lang_blocks = block_paths(upper, ends, levels)
    lang_paths = _below(upper[0], lang_blocks, levels).select(F.col("block").alias("position"), "path", F.col("subroot").alias("root"))
    tops = langs.join(lang_paths, "position").select(
        F.col("of").alias("tree"), "path", F.concat_ws(",", "subroot", "root").alias("subroot")
    )
    paths = block_paths(floors, tops, levels)
    return _proved(rows, floors[0].join(paths, ["tree", "block"]), levels)


def _proved(rows: DataFrame, stored: DataFrame, levels: int) -> DataFrame:
    columns = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def prove(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        for row in blocks.to_pylist():
            block = Block(row["stored"], _height(row["size"], levels), row["leaves"])
            upper = [(step["before"], step["after"]) for step in row["path"]]
            subroot, root = row["subroot"].split(",")
            first = row["block"] * FAN**levels
            values = (leaves[name].to_pylist() for name in ("position", "doc_id", "leaf", "given"))
            for position, doc_id, leaf, given in zip(*values):
                path = block.path(position - first) + upper
                proof = hashed("".join(before + after for before, after in path))
                reached = folded(given, path)
                out.append((doc_id, leaf, subroot, root, proof, reached, reached == root))
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        names = [column.split(" ")[0] for column in columns.split(", ")]
        arrays = zip(*out) if out else [[] for _ in kinds]
        return pa.table({name: pa.array(a, k) for name, a, k in zip(names, arrays, kinds)})

    dealt = rows.select("tree", _block(levels), "position", "doc_id", "leaf", "given")
    stored = stored.select("tree", "block", "size", "leaves", "stored", "path", "subroot")
    return dealt.groupBy("tree", "block").cogroup(stored.groupBy("tree", "block")).applyInArrow(prove, columns)


def manifest_sql() -> str:
    """The rows of ``manifest`` over documents; crc32 is spelled out, eight shifts for each byte."""
    low = f"translate(text, '{_UPPER}', '{_LOWER}')"

    def written(value: str) -> str:
        text = f"CAST({value} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(written(text if name == 'text' else name) for name in FIELDS)})"

    shift = "xor(c >> 1, (c & 1) * 3988292384)"
    byte = f"list_reduce(range(8), lambda c, i: {shift}, xor(c, b))"
    crc = f"list_reduce(list_transform(range(1, 1 + len(doc_id::VARCHAR)), lambda p: ascii(substr(doc_id::VARCHAR, p::BIGINT, 1))::BIGINT), lambda c, b: {byte}, 4294967295::BIGINT)"
    hit = f"xor({crc}, 4294967295) % 3 = 0"
    run = f"PARTITION BY level, tree, position // {FAN} ORDER BY position ROWS BETWEEN"

    def tree(name: str, start: str) -> str:
        return f"""
    {name}(level, tree, position, size, node) AS (
      {start}
      UNION ALL
      SELECT any_value(level) + 1, tree, position // {FAN}, any_value((size + {FAN - 1}) // {FAN}),
             sha256(string_agg(node, '' ORDER BY position))
      FROM {name} WHERE size > 1 GROUP BY tree, position // {FAN}),
    {name}_steps AS (
      SELECT level, tree, position,
             coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
             coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
      FROM {name} WHERE size > 1)"""

    def climb(name: str, steps: str, start: str) -> str:
        return f"""
    {name}(k, level, tree, position, reached, proof) AS (
      {start}
      UNION ALL
      SELECT k, c.level + 1, c.tree, c.position // {FAN}, sha256(before || reached || after), proof || before || after
      FROM {name} c JOIN {steps} s ON c.level = s.level AND c.tree = s.tree AND c.position = s.position),
    {name}_top AS (SELECT k, tree, arg_max(reached, level) AS reached, arg_max(proof, level) AS proof FROM {name} GROUP BY k, tree)"""

    return f"""
    WITH RECURSIVE given AS (
      SELECT row_number() OVER () AS k, doc_id, lang, {written("lang")} AS tree, {leaf("text")} AS leaf,
             CASE WHEN {hit} THEN {leaf(low)} ELSE {leaf("text")} END AS given
      FROM documents),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position,
             count(*) OVER (PARTITION BY tree) AS size
      FROM given),
    {tree("nodes", "SELECT 0, tree, position, size, leaf FROM placed")},
    subroots AS (SELECT tree, node AS subroot FROM nodes WHERE size = 1),
    langs AS (
      SELECT tree, subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS position, count(*) OVER () AS size
      FROM subroots JOIN (SELECT DISTINCT lang, tree FROM given) USING (tree)),
    {tree("tops", "SELECT 0, '', position, size, subroot FROM langs")},
    top AS (SELECT node AS root FROM tops WHERE size = 1),
    {climb("up", "nodes_steps", "SELECT k, 0, tree, position, given, '' FROM placed")},
    {climb("on_up", "tops_steps", "SELECT k, 0, '', position, reached, proof FROM up_top JOIN langs USING (tree)")}
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, reached AS folded_root, reached = root AS verified
    FROM placed JOIN subroots USING (tree) JOIN (SELECT k, reached, proof FROM on_up_top) USING (k), top
    """

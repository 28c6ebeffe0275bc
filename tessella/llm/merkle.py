"""Merkle manifest of a dataset: a tree of SHA-256 digests with incremental witnesses.

Rows are leaves, in a tree of their own for each group (ordered by id), and the trees' roots are leaves of a last tree. Eight
consecutive nodes of a level become one of the next; a last run may be shorter. Leaves are appended in aligned blocks of 8**4,
each by one task: a node that is appended extends the partial witness of every open subtree beside it, and a completed run
hands its subtrees' witnesses down to their leaves. The roots of all blocks are appended in the same way, block of blocks by
block of blocks, until one node a tree is left; on the way back each block's witness extends those of its leaves. A task holds one
block and its witness; what goes on to the next level is an eighth to the power of four of what came in.

Defined cases: null fields are hashed as ``-``; null groups come first and are a tree like any other; within a group rows are
ordered by id (null first), equal ids by leaf, and equal leaves give equal trees in any order; the text that isn't there can't be
tampered with; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.listing import indexed
from .common import attach, materialise

FAN = 8
#: Levels that a task builds at once, and the leaves of such a block.
LEVELS = 4
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODES = "tree long, pos long, n long, hash string"
_WITNESS = "tree long, pos long, hash string, lefts array<string>, rights array<string>"
_PROOF = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def digest(parts: Iterable[str]) -> str:
    """SHA-256 of the parts end to end, in lower-case hexadecimal."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each with its length in front so that no two rows are spelled alike."""
    spelled = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*spelled), 256)


class Subtree:
    """A node of an open run: its digest, its leaves and, so far, its siblings on either side."""

    __slots__ = ("begin", "end", "hash", "left", "right")

    def __init__(self, node: str, begin: int, end: int, left: str):
        self.hash, self.begin, self.end, self.left, self.right = node, begin, end, left, ""


class Appender:
    """A tree that grows leaf by leaf; ``witness[i]`` has what is known of leaf i's siblings, (left, right) a level."""

    def __init__(self) -> None:
        self.witness: list[list[tuple[str, str]]] = []
        self._open: list[list[Subtree]] = [[]]

    def append(self, leaf: str) -> None:
        self.witness.append([])
        self._put(0, leaf, len(self.witness) - 1, len(self.witness))

    def _put(self, level: int, node: str, begin: int, end: int) -> None:
        if level == len(self._open):
            self._open.append([])
        run = self._open[level]
        for sibling in run:
            sibling.right += node
        run.append(Subtree(node, begin, end, "".join(s.hash for s in run)))
        if len(run) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        for s in run:
            step = (s.left, s.right)
            for leaf in range(s.begin, s.end):
                self.witness[leaf].append(step)
        self._put(level + 1, digest(s.hash for s in run), run[0].begin, run[-1].end)

    def seal(self, height: int | None = None) -> str:
        """The root, after all open runs are completed as they are; with a height, that of a tree with so many levels."""
        level = 0
        while True:
            run, above = self._open[level], any(self._open[level + 1 :])
            if run and not above and len(run) == 1 and (height is None or level >= height):
                return run[0].hash
            if run:
                self._complete(level)
            level += 1


def fold(leaf: str, lefts: Iterable[str], rights: Iterable[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights, strict=True):
        leaf = digest((left, leaf, right))
    return leaf


def _height(n: int) -> int | None:
    """Levels of a block of a tree with n leaves: all of them if there are more blocks, else no more than it takes."""
    return LEVELS if n > BLOCK else None


def _grown(block: pa.Table) -> tuple[pa.Table, Appender, str]:
    """A block's nodes in order, the tree over them and its root."""
    block = block.sort_by("pos")
    tree = Appender()
    for node in block["hash"].to_pylist():
        tree.append(node)
    return block, tree, tree.seal(_height(block["n"][0].as_py()))


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).alias("block")


def _up(nodes: DataFrame) -> list[DataFrame]:
    """(tree, pos, n, hash) level by level of blocks, the last with one node a tree; n is the number of nodes in the tree."""

    def roots(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        n = -(-block["n"][0].as_py() // BLOCK)
        return pa.table({"tree": [key[0].as_py()], "pos": [key[1].as_py()], "n": [n], "hash": [_grown(block)[2]]})

    levels = [nodes]
    while levels[-1].where("n > 1").limit(1).count():
        levels.append(materialise(levels[-1].groupBy("tree", _block()).applyInArrow(roots, _NODES), "merkle-roots"))
    return levels


def _down(level: DataFrame, above: DataFrame) -> DataFrame:
    """The witnesses of a level's nodes, from those of the blocks that hold them."""

    def extended(block: pa.Table, witness: pa.Table) -> pa.Table:
        block, tree, _ = _grown(block)
        lefts, rights = (witness[k][0].as_py() for k in ("lefts", "rights"))
        return pa.table(
            {
                "tree": block["tree"],
                "pos": block["pos"],
                "hash": block["hash"],
                "lefts": pa.array([[a for a, _ in w] + lefts for w in tree.witness], pa.list_(pa.string())),
                "rights": pa.array([[b for _, b in w] + rights for w in tree.witness], pa.list_(pa.string())),
            }
        )

    return level.groupBy("tree", _block()).cogroup(above.groupBy("tree", "pos")).applyInArrow(extended, _WITNESS)


def _witnesses(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """The witnesses of the nodes that the second of ``levels`` has, given those of the last; of the blocks over the leaves."""
    for level in reversed(levels[1:-1]):
        top = materialise(_down(level, top), "merkle-witnesses")
    return top


def manifest(df: DataFrame, changed: Column | None = None, change: Column | None = None, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified) for every row.

    ``proof_sha256`` is the digest of the row's siblings from its leaf up to the root. ``folded_root`` is recomputed from these
    and the row's leaf; where ``changed`` holds, from the leaf of the row with ``change`` for its text, and so ``verified`` tells
    whether the row is what the manifest was made from."""
    attach(df.sparkSession)
    kept, other = [F.col(f) for f in fields], F.lit(None).cast("string")
    if changed is not None:
        other = F.when(changed, leaf_digest(*[change if f == text_col else F.col(f) for f in fields]))
    leaves = df.select(F.col(group_col).alias("_group"), F.col(id_col).cast("long").alias("doc_id"), leaf_digest(*kept).alias("hash"), other.alias("other"))
    placed = materialise(indexed(materialise(leaves, "merkle-leaves"), F.asc_nulls_first("_group"), F.asc_nulls_first("doc_id"), "hash"), "merkle-order")
    trees = materialise(placed.groupBy("_group").agg(F.min("idx").alias("tree"), F.count("*").alias("n")), "merkle-trees")
    met = placed.join(trees.withColumnRenamed("_group", "_g"), F.col("_group").eqNullSafe(F.col("_g")))
    nodes = met.select("tree", (F.col("idx") - F.col("tree")).alias("pos"), "n", "hash", "doc_id", "other")

    lower = _up(nodes.select("tree", "pos", "n", "hash"))
    if len(lower) == 1:  # no tree has two leaves; each leaf is its block's root
        lower.append(lower[0])
    subroots = lower[-1]
    n = trees.count()
    upper = _up(materialise(indexed(subroots.select(F.col("tree").alias("of"), "hash"), "of", into="pos").withColumns({"tree": F.lit(0).cast("long"), "n": F.lit(n).cast("long")}), "merkle-subroots"))
    root = (upper[-1].first() or {"hash": None})["hash"]
    none = F.array().cast("array<string>")
    top = upper[-1].select("tree", "pos", "hash", none.alias("lefts"), none.alias("rights"))
    top = materialise(_down(upper[0], _witnesses(upper, top)), "merkle-witnesses") if len(upper) > 1 else top
    named = top.join(upper[0].select("of", "pos"), "pos").select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "hash", "lefts", "rights")
    blocks = _witnesses(lower, named).join(subroots.select("tree", F.col("hash").alias("subroot")), "tree")

    def proofs(block: pa.Table, witness: pa.Table) -> pa.Table:
        block, tree, _ = _grown(block)
        lefts, rights = (witness[k][0].as_py() for k in ("lefts", "rights"))
        proof, folded = [], []
        for leaf, other, steps in zip(block["hash"].to_pylist(), block["other"].to_pylist(), tree.witness, strict=True):
            left, right = [a for a, _ in steps] + lefts, [b for _, b in steps] + rights
            proof.append(digest(a + b for a, b in zip(left, right, strict=True)))
            folded.append(fold(other or leaf, left, right))
        subroot = pa.array(witness["subroot"].to_pylist() * len(proof), pa.string())
        return pa.table({"doc_id": block["doc_id"], "leaf": block["hash"], "subroot": subroot, "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string())})

    found = nodes.groupBy("tree", _block()).cogroup(blocks.groupBy("tree", "pos")).applyInArrow(proofs, _PROOF)
    return found.select(F.col("doc_id").alias(id_col), "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def manifest_sql(levels: int = 6, langs: int = 2) -> str:
    """The same in DuckDB, over ``documents`` with up to 8**levels rows a language and 8**langs languages."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: "sha256(" + " || ".join([*(field(c) for c in FIELDS[:-1]), field(text)]) + ")"
    ctes = [
        f"docs AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN crc % 3 = 0 THEN {leaf(lower)} END AS other FROM (SELECT *, {_CRC} AS crc FROM documents))",
        "a0 AS (SELECT coalesce('+' || lang, '-') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS hash, doc_id, leaf, other FROM docs)",
    ]

    def level(name: str, k: int) -> str:
        one = f"(SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k})"
        return f"{name}{k + 1} AS (SELECT tree, pos // {FAN} AS pos, CASE WHEN max(n) = 1 THEN max(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash FROM {one} GROUP BY tree, pos // {FAN})"

    def sides(name: str, k: int, at: str) -> str:
        by = f"(PARTITION BY tree, pos // {FAN} ORDER BY pos ROWS BETWEEN "
        return f"{name}w{k} AS (SELECT tree AS {at}tree, pos AS {at}pos, coalesce(string_agg(hash, '') OVER {by}UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(hash, '') OVER {by}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r, count(*) OVER (PARTITION BY tree) > 1 AS real FROM {name}{k})"

    for k in range(levels):
        ctes += [level("a", k), sides("a", k, "")]
    ctes.append(f"b0 AS (SELECT 'all' AS tree, row_number() OVER (ORDER BY tree <> '-', encode(tree)) - 1 AS pos, hash, tree AS lang FROM a{levels})")
    for k in range(langs):
        ctes += [level("b", k), sides("b", k, "")]
    joins, proof, fold_, x = [], [], [], "coalesce(other, leaf)"
    for k in range(levels):
        joins.append(f"JOIN aw{k} ON aw{k}.tree = a0.tree AND aw{k}.pos = a0.pos // {FAN**k}")
    joins.append("JOIN b0 ON b0.lang = a0.tree")
    for k in range(langs):
        joins.append(f"JOIN bw{k} ON bw{k}.pos = b0.pos // {FAN**k}")
    for i, w in enumerate([f"aw{k}" for k in range(levels)] + [f"bw{k}" for k in range(langs)]):
        proof.append(f"{w}.l || {w}.r")
        fold_.append(f"f{i + 1} AS (SELECT *, CASE WHEN real{i} THEN sha256(l{i} || x{i} || r{i}) ELSE x{i} END AS x{i + 1} FROM f{i})")
    steps = ", ".join(f"{w}.l AS l{i}, {w}.r AS r{i}, {w}.real AS real{i}" for i, w in enumerate([f"aw{k}" for k in range(levels)] + [f"bw{k}" for k in range(langs)]))
    ctes.append(f"f0 AS (SELECT a0.doc_id, a0.leaf, b0.hash AS subroot, sha256({' || '.join(proof)}) AS proof_sha256, {x} AS x0, {steps} FROM a0 {' '.join(joins)})")
    last = f"x{levels + langs}"
    return "WITH " + ",\n".join(ctes + fold_) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, {last} AS folded_root, {last} = root AS verified FROM f{levels + langs}, (SELECT hash AS root FROM b{langs})"


#: CRC-32 of the decimal id: a byte at a time, eight steps a byte.
_CRC = "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda a, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda u, v: CASE WHEN u % 2 = 1 THEN xor(u // 2, 3988292384) ELSE u // 2 END, xor(a, b)), 4294967295), 4294967295)"

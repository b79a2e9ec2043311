"""Conversation prefix trie by union-find over the longest common prefixes of sorted neighbours.

A conversation is the sequence of its turns, each known by the digest of its role and text. Equal sequences fall into
classes first (partial counts before the shuffle), so that a group of copies is one row. Classes are dealt by ranges of
their sequences and sorted. In chunks of a partition every two neighbours have an edge, as deep as their common prefix;
edges are taken from the deepest to the shallowest, and a union-find joins the components at their ends: each join
makes a branching node or adds a child to one, and the chain of turns between it and the joined component becomes
nodes with one child.

Nodes on the path of a chunk's first or last class may go on in the chunk beside it: they stay open, each with what its
closed subtrees add up to. Forests of neighbouring chunks, and then of FAN neighbouring partitions, round by round, are
merged by the digest of the prefix; what does not touch the border any more is closed from the deepest on and its sums
are handed to its parent. A task holds the two border paths of FAN forests, whatever the number of conversations.

Edge cases: rows without a conversation id belong to no conversation; a null role or text is empty; turns are ordered
by number (null first), equal ones by role and digest of the text; repeated rows are turns of their own; very long texts
are only hashed and counted; an empty table has no nodes, not even a root; other columns are left out. All turns of one
conversation (about 40 bytes each) are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import in_order, ordered_digests, partition_id
from .tables import materialize

#: Turns of sorted classes in one chunk; forests merged in one call.
CHUNK, FAN = 100_000, 16
WORD = r"[^\x20\x09-\x0D]+"

NODE = "forest long, key string, parent_key string, first boolean, last boolean, depth long, words long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, cls string"
COLUMNS = [c.split()[0] for c in NODE.split(", ")]


class Node:
    """A node and what its closed subtrees add up to; ``key`` is the digest of its prefix while it is on a border path."""

    __slots__ = ("depth", "words", "conv", "n", "children", "leaves", "saved", "cls", "parent", "key", "parent_key", "left", "right")

    def __init__(self, depth: int, words: int, conv: int, n: int, cls: str | None = None):
        self.depth, self.words, self.conv, self.n, self.cls = depth, words, conv, n, cls
        self.children = self.leaves = self.saved = 0
        self.parent: Node | None = None
        self.key: str | None = None
        self.parent_key: str | None = None
        self.left = self.right = False

    def close(self, parent: Node | None) -> None:
        """Its subtree is complete: count it, and add it to its parent."""
        self.leaves = self.leaves if self.children else 1
        self.saved += (self.n - 1) * self.words
        if parent is not None:
            parent.children, parent.leaves, parent.saved = parent.children + 1, parent.leaves + self.leaves, parent.saved + self.saved

    def row(self, forest: int | None) -> tuple:
        inside = self.parent is not None and self.parent.key is None
        above = self.parent.key if self.parent is not None else self.parent_key
        return (forest, self.key, above, self.left, self.right, self.depth, self.words, self.conv, self.parent.conv if inside else None, self.n, self.children, self.leaves, self.saved, self.cls)


def frame(nodes: list[Node], forest: int | None) -> pd.DataFrame:
    out = pd.DataFrame([n.row(forest) for n in nodes], columns=COLUMNS)
    return out.assign(forest=out["forest"].astype("Int64"), parent_conv_id=out["parent_conv_id"].astype("Int64"))


def common(a: list, b: list) -> int:
    """How many turns two sequences share from the start."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def prefix_keys(path: list[str]) -> list[str]:
    """Digests of all prefixes, the empty one first."""
    keys = [""]
    for k in path:
        keys.append(hashlib.md5((keys[-1] + k).encode()).hexdigest())
    return keys


def chunk_forest(classes: list[tuple]) -> tuple[list[Node], dict[str, Node]]:
    """Sorted different sequences (digest, turn keys, words, smallest conv_id, size) -> closed nodes, open nodes by prefix digest."""
    paths, words = [c[1] for c in classes], [c[2] for c in classes]
    m = len(classes)
    top = [Node(len(p), w[-1] if p else 0, conv, n, cls) for cls, p, w, conv, n in classes]
    root, low, high, made = list(range(m)), list(range(m)), list(range(m)), list(top)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def attach(node: Node, i: int, up: Node) -> None:
        """node, the root of component i, becomes a child of up."""
        node.parent, node.left, node.right = up, low[i] == 0, high[i] == m - 1
        if not (node.left or node.right):
            node.close(up)

    def above(i: int, depth: int) -> Node:
        """The node over component i at ``depth``; what is between them has one child each."""
        node = top[i]
        while node.depth > depth:
            up = Node(node.depth - 1, words[low[i]][node.depth - 2] if node.depth > 1 else 0, node.conv, node.n)
            made.append(up)
            attach(node, i, up)
            node = up
        return node

    # of edges of one depth the left ones first: the right component of an edge is then always deeper than the edge
    for depth, i in sorted(((common(paths[i], paths[i + 1]), i) for i in range(m - 1)), key=lambda e: (-e[0], e[1])):
        a, b = find(i), find(i + 1)
        up, child = above(a, depth), above(b, depth + 1)
        attach(child, b, up)
        up.conv, up.n = min(up.conv, child.conv), up.n + child.n
        root[b], high[a], top[a] = a, high[b], up
    origin = above(find(0), 0)
    origin.left = origin.right = True
    sides = prefix_keys(paths[0]), prefix_keys(paths[-1])
    opened = {}
    for node in made:
        if node.left or node.right:
            node.key = sides[0 if node.left else 1][node.depth]
            opened[node.key] = node
    for node in opened.values():
        node.parent_key = node.parent.key if node.parent is not None else None
    return [n for n in made if n.key is None], opened


def merge(forests: list[dict[str, Node]], whole: bool) -> tuple[list[Node], dict[str, Node]]:
    """Open nodes of neighbouring forests, in order -> what closes, and the open nodes of all of them as one forest.

    ``whole``: there are no others, all nodes close.
    """
    found: dict[str, Node] = {}
    for k, forest in enumerate(forests):
        for key, node in forest.items():
            node.left, node.right, node.parent = node.left and k == 0, node.right and k == len(forests) - 1, None
            if (to := found.setdefault(key, node)) is not node:
                to.n, to.conv, to.cls = to.n + node.n, min(to.conv, node.conv), to.cls or node.cls
                to.children, to.leaves, to.saved = to.children + node.children, to.leaves + node.leaves, to.saved + node.saved
                to.left, to.right = to.left or node.left, to.right or node.right
    closed = sorted((n for n in found.values() if whole or not (n.left or n.right)), key=lambda n: -n.depth)
    for node in closed:
        node.close(found.get(node.parent_key) if node.parent_key is not None else None)
        del found[node.key]
    return closed, found


def _grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted classes of a partition -> closed nodes, and the open nodes of its forest."""
    forest, held, turns = None, [], 0

    def step() -> list[Node]:
        nonlocal forest
        closed, opened = chunk_forest(held)
        more, forest = merge([opened] if forest is None else [forest, opened], False)
        return closed + more

    for pdf in batches:
        for cls, path, words, conv, n in zip(*[pdf[c].tolist() for c in ("cls", "path", "words", "conv_id", "n_convs")]):
            held.append((cls, list(path), [int(w) for w in words], conv, n))
            turns += len(path) + 1
            if turns > CHUNK:
                yield frame(step(), None)
                held, turns = [], 0
    if held:
        yield frame(step(), None)
    if forest is not None:
        yield frame(list(forest.values()), partition_id())


def _join(whole: bool):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        forests = []
        for _, rows in pdf.sort_values("forest").groupby("forest"):
            forests.append({})
            for r in rows.to_dict("records"):
                node = Node(r["depth"], r["words"], r["conv_id"], r["n_convs"], r["cls"])
                node.children, node.leaves, node.saved = r["n_children"], r["n_leaves"], r["saved_tokens"]
                node.key, node.parent_key, node.left, node.right = r["key"], r["parent_key"], r["first"], r["last"]
                forests[-1][node.key] = node
        closed, opened = merge(forests, whole)
        return pd.concat([frame(closed, None), frame(list(opened.values()), int(key[0]))])

    return run


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> (conv_id, turns array<struct<key, words>>): turns in order, by digest and number of words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("key"), F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "key", "words"))).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words"))).alias("turns"))


def trie(rows: DataFrame) -> DataFrame:
    """(conv_id, turns) as ``sequences`` gives them -> one row per node.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, cls; the conversations
    that end in a node are those of ``members`` with its cls.
    """
    classes = members(rows).groupBy("cls").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("turns").alias("turns"))
    classes = materialize(classes.select("cls", "conv_id", "n_convs", F.col("turns.key").alias("path"), F.col("turns.words").alias("words")), "classes")
    now = materialize(in_order(classes, ["path"], []).mapInPandas(_grow, NODE), "nodes")
    done = now.where("forest is null")
    while True:
        left = now.where("forest is not null")
        most = left.agg(F.max("forest")).first()[0]
        if most is None:
            break
        now = left.groupBy(F.floor(F.col("forest") / FAN)).applyInPandas(_join(most < FAN), NODE)
        now = materialize(now, "nodes")
        done = done.unionAll(now.where("forest is null"))
    # children of a node that was on a border learn its smallest conversation from it
    border = done.where("key is not null").select(F.col("key").alias("border"), F.col("conv_id").alias("above"))
    nodes = done.join(border, F.col("parent_key") == F.col("border"), "left")
    return nodes.select("conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "cls")


def members(rows: DataFrame) -> DataFrame:
    """rows with ``cls``, the digest of the whole sequence."""
    return rows.withColumn("cls", F.md5(F.array_join("turns.key", "").cast("binary")))


def ends(rows: DataFrame) -> DataFrame:
    """(cls, id_sha256): digest of the ids of each class, ascending and joined with commas."""
    ids = in_order(members(rows).select("cls", "conv_id", F.col("conv_id").cast("string").alias("id")), ["cls", "conv_id"], [])
    found = ordered_digests(ids, "cls", {"id": ","}, [])
    return found.select("cls", F.col("id").alias("ends_sha256"))

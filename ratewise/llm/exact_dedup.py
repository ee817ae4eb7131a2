"""Exact deduplication with Patricia tries.

Texts are equal when their UTF-8 bytes agree after lower-casing A-Z.  Each map task folds its
texts into a trie (so a copy that holds a third of all rows leaves a task once per window), the
distinct texts are dealt by (content hash, length), and each reduce task inserts the full byte
strings into one trie whose terminal nodes hold the preferred identifier and the number of rows.
A trie above its memory budget spills its largest first-level subtrees to the task's own scratch
space (read again by that task only) and resolves them one after the other, each without the prefix
that all its keys share: a spilled subtree of one text is written once, however long the text.  Rows then look up their class by (hash, length,
sha256 of the text); classes of one row need no look-up.

Defined results: null text counts as empty; a null id is preferred last; rows equal in both id
and text belong to one class and, when that id is the preferred one, are all marked kept; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import text_bytes

WINDOW_BYTES = 16 << 20     # text a map task folds before it passes its distinct texts on
TRIE_BYTES = 64 << 20       # text a reduce task holds before it spills a subtree


class _Node:
    __slots__ = ("label", "children", "owner", "count")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.count = label, None, None, 0


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by halving."""
    lo, hi = 0, min(len(a), len(b) - at)
    if a[:hi] == b[at:at + hi]:
        return hi
    while lo < hi - 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid
    return lo


class PatriciaTrie:
    """Compressed radix trie over byte strings; a terminal keeps the preferred owner and a count."""

    def __init__(self, prefer, budget: int | None = None):
        self.prefer, self.budget = prefer, budget
        self.root = _Node(b"")
        self.held: dict[int, int] = {}                 # bytes below each first byte of the root
        self.spilled: dict[int, object] = {}           # first byte -> file of (key, owner, count)
        self.shared: dict[int, bytes] = {}             # first byte -> prefix of all keys in that file
        self.bytes = 0

    def insert(self, key: bytes, owner, count: int) -> None:
        branch = key[0] if key else -1
        if branch in self.spilled:
            pickle.dump((key, owner, count), self.spilled[branch])
            shared = self.shared[branch]
            self.shared[branch] = shared[:_common(shared, key, 0)]
            return
        added = self._insert(key, owner, count)
        if added:
            self.bytes += added
            self.held[branch] = self.held.get(branch, 0) + added
            if self.budget and self.bytes > self.budget:
                self._spill()

    def _insert(self, key: bytes, owner, count: int) -> int:
        node, at = self.root, 0
        while at < len(key):
            if node.children is None:
                node.children = {}
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                node.children[key[at]] = child
                child.owner, child.count = owner, count
                return len(child.label) + 200
            n = _common(child.label, key, at)
            if n < len(child.label):                   # split the edge
                upper = _Node(child.label[:n])
                child.label = child.label[n:]
                upper.children = {child.label[0]: child}
                node.children[key[at]] = upper
                child = upper
            node, at = child, at + n
        if node.count == 0:
            node.owner, node.count = owner, count
            return 200
        node.owner, node.count = self.prefer(node.owner, owner), node.count + count
        return 0

    def _walk(self, node: _Node, prefix: bytes) -> Iterator[tuple[bytes, object, int]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.count:
                yield prefix, node.owner, node.count
            for child in (node.children or {}).values():
                stack.append((child, prefix + child.label))

    def _spill(self) -> None:
        """Move the largest first-level subtrees to files until half of the budget is free."""
        for branch, size in sorted(self.held.items(), key=lambda x: -x[1]):
            if self.bytes <= self.budget // 2:
                break
            if branch < 0:
                continue
            out = tempfile.TemporaryFile(dir=os.environ.get("TMPDIR"))  # unlinked at once: nothing stays behind
            child = self.root.children.pop(branch)
            for item in self._walk(child, child.label):
                pickle.dump(item, out)
            self.spilled[branch], self.shared[branch] = out, child.label
            self.bytes -= self.held.pop(branch)

    def items(self) -> Iterator[tuple[bytes, object, int]]:
        """(key, owner, count) of every distinct key; spilled subtrees come last, one at a time."""
        yield from self._walk(self.root, b"")
        self.root = _Node(b"")
        left = [(self.shared[k], len(self.shared[k]), out) for k, out in self.spilled.items()]
        while left:
            prefix, skip, out = left.pop()
            out.seek(0)
            below = PatriciaTrie(self.prefer, self.budget)
            while True:
                try:
                    key, owner, count = pickle.load(out)
                except EOFError:
                    break
                below.insert(key[skip:], owner, count)
            out.close()
            yield from below._walk(below.root, prefix)
            left += [(prefix + below.shared[k], len(below.shared[k]), f) for k, f in below.spilled.items()]


def _largest(a, b):
    return b if a is None else a if b is None else max(a, b)


def _smallest(a, b):
    return b if a is None else a if b is None else min(a, b)


def _hash(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _emit(trie: PatriciaTrie, rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The trie's distinct texts as (h, n, text, owner, copies)."""
    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(h, pa.int64()), pa.array(n, pa.int64()), pa.array(t, pa.binary()),
             pa.array(o, pa.int64()), pa.array(c, pa.int64())], ["h", "n", "text", "owner", "copies"])
    h, n, t, o, c, held = [], [], [], [], [], 0
    for key, owner, count in trie.items():
        text = key[8:]
        h.append(int.from_bytes(key[:8], "big", signed=False) - (1 << 63))
        n.append(len(text)), t.append(text), o.append(owner), c.append(count)
        held += len(text)
        if len(h) >= rows or held >= size:
            yield batch()
            h, n, t, o, c, held = [], [], [], [], [], 0
    if h:
        yield batch()


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "smallest") -> DataFrame:
    """Distinct texts: h (content hash), n (bytes), sha (of the lower-cased bytes), owner (the
    smallest or largest id that has the text), copies (rows that have it)."""
    prefer = {"smallest": _smallest, "largest": _largest}[keep]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(prefer)
        for b in batches:
            for owner, text in zip(b.column(0).to_pylist(), b.column(1)):
                low = text.as_buffer().to_pybytes().lower()
                trie.insert((_hash(low) + (1 << 63)).to_bytes(8, "big") + low, owner, 1)
                if trie.bytes > WINDOW_BYTES:
                    yield from _emit(trie)
                    trie = PatriciaTrie(prefer)
        yield from _emit(trie)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(prefer, TRIE_BYTES)
        for b in batches:
            for h, text, owner, copies in zip(b.column("h").to_pylist(), b.column("text"),
                                              b.column("owner").to_pylist(), b.column("copies").to_pylist()):
                trie.insert((h + (1 << 63)).to_bytes(8, "big") + text.as_buffer().to_pybytes(), owner, copies)
        for out in _emit(trie):
            sha = pa.array([hashlib.sha256(t.as_buffer()).digest() for t in out.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [out.column("h"), out.column("n"), sha, out.column("owner"), out.column("copies")],
                ["h", "n", "sha", "owner", "copies"])

    folded = rows.mapInArrow(fold, "h long, n long, text binary, owner long, copies long")
    return folded.repartition("h", "n").mapInArrow(merge, "h long, n long, sha binary, owner long, copies long")


def _text_key(texts: pa.Array) -> pa.Array:
    low = [t.as_buffer().to_pybytes().lower() for t in texts]
    return pa.StructArray.from_arrays(
        [pa.array([_hash(t) for t in low], pa.int64()), pa.array([len(t) for t in low], pa.int64()),
         pa.array([hashlib.sha256(t).digest() for t in low], pa.binary())], ["h", "n", "sha"])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "smallest") -> DataFrame:
    """Every row of ``docs``, its columns in the struct ``row``, with keep_id, group_size, kept and
    text_sha256 of its class."""
    key = F.arrow_udf(_text_key, "struct<h:long,n:long,sha:binary>")
    classes = text_classes(docs, id_col, text_col, keep).where("copies > 1")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(id_col).cast("long").alias("id"),
                        key(text_bytes(text_col)).alias("key"))
    keyed = keyed.select("row", "id", "key.h", "key.n", "key.sha")
    joined = keyed.join(classes, ["h", "n", "sha"], "left")
    owner = F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("owner"))
    return joined.select("row", owner.alias("keep_id"), F.coalesce("copies", F.lit(1)).alias("group_size"),
                         F.col("id").eqNullSafe(owner).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          keep: str = "smallest") -> DataFrame:
    """``docs`` without the rows whose text another, preferred row has; same columns."""
    return exact_duplicates(docs, id_col, text_col, keep).where("kept").select("row.*")

"""Near duplicates by MinHash: banded candidates, sequential Bayesian pruning, exact verification.

Documents with equal sets of word shingles form a class; classes are compared, not copies.  A
class has a MinHash signature.  ``ROWS`` hashes at a time form a band, and classes that agree in
a band are candidates.  Signatures of a candidate pair are compared ``STEP`` hashes at a time;
after each step a pair is dropped when the posterior probability that its similarity reaches
the threshold is below ``MISS``.  Pairs that are left are confirmed on their full sets.

No group emits its pairs.  Each member of a band's group is first compared with the group's
centre only.  Pairs that are left connect documents, and only members of a group that are not
connected yet are compared further: those of its largest part against the others, and the others
among themselves, in tiles of bounded size inside the tasks, which give fewer links than they
have members.  So every candidate pair is compared or already connected, and similar documents
end in one cluster.  Inside the clusters, far smaller than the corpus, the same two steps are
taken with the full sets: centres first, then whatever confirmed links have not connected.

With similarity s, a pair shares no band with probability (1 - s**ROWS)**BANDS: below 7e-7 at 0.8.

Rows are linked through their sets alone: rows with equal or null ids are nodes of their own.
Documents without words are linked with nothing.  A component is named by its least id (null
if it has none).  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.workspace import materialise

from . import text as X

BANDS, ROWS = 36, 5
HASHES = BANDS * ROWS
STEP, MISS = 20, 1e-6
#: Members of a tile's side.
TILE = 256
_rng = np.random.default_rng(20240229)
_FACTORS = (_rng.integers(0, 2**31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFTS = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_TEXTS = "doc_id long, text string"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def _shingles(chunk: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    data, places = X.flat(chunk["text"])
    found = X.words(X.lower(data), places)
    h = X.hashes(found.vocabulary)[found.codes]
    each = h.copy()
    for i in range(1, size):
        each[: len(h) - i] = _mixed(each[: len(h) - i]) * _A + h[i:]
    each = _mixed(each)
    out = []
    for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(each[a : b - size + 1]))
        elif b > a:  # the whole sequence is the one shingle
            whole = h[a : a + 1].copy()
            for x in h[a + 1 : b]:
                whole = _mixed(whole) * _A + x
            out.append(_mixed(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signature(hashes: np.ndarray) -> np.ndarray:
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for i in range(0, len(x), 2048):  # bounds the product for very long texts
        np.minimum(least, (x[i : i + 2048, None] * _FACTORS + _SHIFTS).min(0), out=least)
    return least


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(signatures), BANDS), np.uint64)
    for i in range(ROWS):
        keys = _mixed(keys * _A + signatures[:, i::ROWS].astype(np.uint64) + np.uint64(i + 1))
    return keys.astype(np.int64)


def _prints(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in X.chunks(batches, "text"):
            sets = _shingles(chunk, size)
            full = [len(s) > 0 for s in sets]
            signatures = np.stack([_signature(s) for s in sets])
            keys = _band_keys(signatures)
            short = (signatures & np.uint32(255)).astype(np.uint8)  # one byte of each hash is enough to estimate
            yield pa.RecordBatch.from_arrays(
                [
                    chunk["doc_id"],
                    chunk["text_hash"],
                    pa.array(map(len, sets), pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() if f else None for s, f in zip(sets, full)], pa.binary()),
                    pa.array([r.tobytes() if f else None for r, f in zip(short, full)], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, len(sets) * BANDS + 1, BANDS, np.int32), pa.array(keys.reshape(-1))),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest", "signature", "bands"],
            )

    return make


PRINTS = "doc_id long, text_hash long, n_shingles long, digest binary, signature binary, bands array<long>"


def least_matches(similarity: float, miss: float = MISS) -> np.ndarray:
    """For 0, 1, .. HASHES compared hashes: fewer matches than this, and the pair is dropped.

    With a flat prior the posterior of the similarity after m of n matches is Beta(m + 1,
    n - m + 1).  P(similarity >= s) is then a binomial sum: at most m successes in n + 1 trials
    of chance s.  One byte per hash also agrees by chance, which the chance of a match allows for.
    """
    s = similarity + (1 - similarity) / 256
    out = np.zeros(HASHES + 1, np.int64)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, HASHES + 2)))])
    for n in range(1, HASHES + 1):
        k = np.arange(n + 2)
        tail = np.exp(logs[n + 1] - logs[k] - logs[n + 1 - k] + k * np.log(s) + (n + 1 - k) * np.log1p(-s))
        out[n] = int(np.searchsorted(np.cumsum(tail), miss))
    return out


def survivors(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Indices of the pairs of signatures that no step drops."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i in range(0, HASHES, STEP):
        matches = matches + (a[alive, i : i + STEP] == b[alive, i : i + STEP]).sum(1)
        keep = matches >= least[min(i + STEP, HASHES)]
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def _pruned(least: np.ndarray):
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.array(survivors(_bytes(batch["sig_a"]), _bytes(batch["sig_b"]), least))
            yield pa.RecordBatch.from_arrays([batch["a"].take(kept), batch["b"].take(kept)], names=["a", "b"])

    return prune


def _tile_links(least: np.ndarray, percent: int | None):
    """Links across components in each tile; rows come sorted by tile.

    Sides 0 and 1 of a tile are compared, and 1 and 2; side 1 also with itself where ``inner``
    says so.  With ``percent`` a link is a pair confirmed on the full sets, and pairs that links
    have connected are left out.  Without, links are estimates that keep connected what no step
    drops; either way a tile gives fewer links than it has members.
    """

    def compared(left: list[dict], right: list[dict], roots: dict[int, int]) -> Iterator[tuple[int, int]]:
        def root(x: int) -> int:
            while roots.setdefault(x, x) != x:
                roots[x] = x = roots.setdefault(roots[x], roots[x])
            return x

        ca, cb = (np.array([r["component"] for r in x]) for x in (left, right))
        i, j = np.nonzero((ca[:, None] != cb[None, :]) & (np.triu(np.ones((len(ca), len(cb)), bool), 1) if left is right else True))
        sa, sb = (np.frombuffer(b"".join(r["signature"] for r in x), np.uint8).reshape(-1, HASHES) for x in (left, right))
        for k in range(0, len(i), 4096):
            at = survivors(sa[i[k : k + 4096]], sb[j[k : k + 4096]], least) + k
            for x, y in zip(i[at].tolist(), j[at].tolist()):
                a, b = left[x], right[y]
                ends = (a["component"], b["component"]) if percent else (a["node"], b["node"])
                ra, rb = root(ends[0]), root(ends[1])
                if ra != rb and (not percent or _similar(a["hashes"], b["hashes"], percent)):
                    roots[ra] = rb
                    yield a["node"], b["node"]

    def close(rows: list[dict]) -> Iterator[tuple[int, int]]:
        sides, roots = [[r for r in rows if r["side"] == k] for k in (0, 1, 2)], {}
        for left, right in ((0, 1), (1, 2)):
            if sides[left] and sides[right]:
                yield from compared(sides[left], sides[right], roots)
        if sides[1] and sides[1][0]["inner"]:
            yield from compared(sides[1], sides[1], roots)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, []
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["tile"] != tile:
                    found += close(rows)
                    tile, rows = row["tile"], []
                rows.append(row)
            yield _link_batch(found)
        yield _link_batch(list(close(rows)))

    return links


def _link_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _similar(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two sorted sets of hashes share at least ``percent`` of their union."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def tiled(members: DataFrame, group: list[str]) -> DataFrame:
    """Members (node, component) of each group in tiles that meet every two components.

    A group with one component gives nothing.  Its largest component is cut into blocks, and so
    are the others together; each block of the first meets each of the others, and the others
    meet among themselves.  A member is copied once per block that it meets.
    """
    parts = members.groupBy(*group, "component").agg(F.count("*").alias("n"))
    groups = (
        parts.groupBy(*group)
        .agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select(
            *group,
            F.col("main.component").alias("main"),
            F.ceil(F.col("main.n") / TILE).cast("int").alias("main_blocks"),
            F.ceil((F.col("n") - F.col("main.n")) / TILE).cast("int").alias("blocks"),
        )
    )
    is_main = F.col("component") == F.col("main")
    own = F.pmod(F.hash("node"), F.when(is_main, F.col("main_blocks")).otherwise(F.col("blocks")))
    placed = members.join(groups, group).withColumn("own", own)

    def tile(x: Column, y: Column, side: Column, inner: Column) -> Column:
        return F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), side.cast("int").alias("side"), inner.alias("inner"))

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    # tile (m, i): block m of the main component against block i of the others, and in (0, i) also
    # block i against itself; tile (-1 - i, j): blocks i < j of the others
    across = F.transform(upto("blocks"), lambda i: tile(F.col("own"), i, F.lit(0), F.lit(False)))
    to_main = F.transform(upto("main_blocks"), lambda m: tile(m, F.col("own"), F.lit(1), m == 0))
    among = F.transform(
        F.filter(upto("blocks"), lambda j: j != F.col("own")),
        lambda j: tile(-1 - F.least(F.col("own"), j), F.greatest(F.col("own"), j), F.when(F.col("own") < j, 1).otherwise(2), F.lit(False)),
    )
    tiles = F.when(is_main, across).otherwise(F.concat(to_main, among))
    return placed.select(*group, "node", "component", F.inline(tiles)).select(
        F.concat_ws(":", *group, "x", "y").alias("tile"), "node", "component", "side", "inner"
    )


def _sets(size: int):
    """The shingle hashes of wanted classes, from the text of one of their documents."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in X.chunks(batches, "text"):
            sets = [s.tobytes() for s in _shingles(chunk, size)]
            same = [blake2b(s, digest_size=16).digest() == d.as_py() for s, d in zip(sets, chunk["digest"])]
            out = pa.RecordBatch.from_arrays([chunk["node"], pa.array(sets, pa.binary())], names=["node", "hashes"])
            yield out.filter(pa.array(same, pa.bool_()))

    return make


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [_similar(x.as_py(), y.as_py(), percent) for x, y in zip(batch["set_a"], batch["set_b"])]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return confirm


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the least node that it reaches.

    Each round every node points to the least of itself and its neighbours, pointers are
    followed twice, and links are drawn between what they point to; few rounds are left with
    links.  Each round is written down.
    """
    links = materialise(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = None
    while not links.isEmpty():
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        hook = materialise(ends.groupBy("node").agg(F.least("node", F.min("other")).alias("to")))
        for _ in range(2):
            nxt = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
            hook = materialise(hook.join(nxt, "to").select("node", F.col("further").alias("to")))
        if found is None:
            found = hook
        else:
            step = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
            found = materialise(found.join(step, "to", "left").select("node", F.coalesce("further", "to").alias("to")))
        left, right = (hook.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab")
        drawn = links.join(left, "a").join(right, "b").where("a_to != b_to")
        links = materialise(drawn.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct())
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.select("node", F.col("to").alias("component"))


def _row() -> Column:
    """What names a row and its text, ordered by id, those without one last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")


class _Search:
    """The steps for one table of texts."""

    def __init__(self, texts: DataFrame, size: int, percent: int) -> None:
        self.texts, self.size, self.percent = texts, size, percent
        self.least = least_matches(percent / 100)
        self.prints = materialise(texts.mapInArrow(X.tidy(_prints(size)), PRINTS))
        classes = self.prints.where("digest is not null").groupBy("digest").agg(
            F.min(_row()).alias("first"), F.min("signature").alias("signature"), F.first("bands").alias("bands")
        )
        self.classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()))
        members = self.classes.select("node", F.posexplode("bands").alias("band", "key"))
        groups = members.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
        self.shared = materialise(members.join(groups, ["band", "key"]))

    def sets(self, nodes: DataFrame) -> DataFrame:
        """The shingle hashes of some classes, in the shared folder.

        The wanted classes grow with the corpus, so the join is planned for many at any size.
        """
        wanted = materialise(nodes.join(self.classes.select("node", "first", "digest"), "node"))
        texts = self.texts.hint("merge")
        same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
        found = texts.join(wanted, same).select("node", "digest", "text")
        return materialise(found.mapInArrow(X.tidy(_sets(self.size)), "node long, hashes binary").dropDuplicates(["node"]))

    def star_pairs(self) -> DataFrame:
        """Each member of a band's group with the group's centre.

        The centre is the member whose bands are shared most: of near copies of one text, the
        text itself, which copies resemble more than each other.
        """
        shared = self.shared.groupBy("node").agg(F.sum("n").alias("score"))
        scored = self.shared.join(shared, "node")
        centres = scored.groupBy("band", "key").agg(F.max(F.struct("score", "node"))["node"].alias("a"))
        pairs = self.shared.join(centres, ["band", "key"]).where("node != a")
        pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        sig_a, sig_b = (self.classes.select(F.col("node").alias(c), F.col("signature").alias(f"sig_{c}")) for c in "ab")
        both = pairs.join(sig_a, "a").join(sig_b, "b").select("a", "b", "sig_a", "sig_b")
        return both.mapInArrow(X.tidy(_pruned(self.least)), "a long, b long")

    def met(self, members: DataFrame, labels: DataFrame, group: list[str], known: DataFrame, percent: int | None) -> DataFrame:
        """Links between members of one group that ``labels`` has in different components."""
        named = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        rows = tiled(named, group).join(known, "node").repartition("tile").sortWithinPartitions("tile")
        return materialise(rows.mapInArrow(X.tidy(_tile_links(self.least, percent)), "a long, b long"))

    def labels(self) -> DataFrame:
        """Candidates first: pairs that no step drops connect nodes to clusters.  Then each
        cluster's members are confirmed with their full sets, again centre first."""
        signatures = self.classes.select("node", "signature")
        star = materialise(self.star_pairs())
        more = self.met(self.shared.select("band", "key", "node"), components(star), ["band", "key"], signatures, None)
        clusters = materialise(components(star.union(more)).withColumnRenamed("component", "cluster"))
        sets = self.sets(clusters.select("node"))
        a, b = (sets.select(F.col("node").alias(c), F.col("hashes").alias(f"set_{c}")) for c in "ab")
        full = star.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
        first = materialise(full.mapInArrow(X.tidy(_confirmed(self.percent)), "a long, b long"))
        second = self.met(clusters, components(first), ["cluster"], sets.join(signatures, "node"), self.percent)
        return components(first.union(second))


def _named(docs: DataFrame, size: int, percent: int, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """The prints of all rows, and per class: digest, component and the first row of the class."""
    text = F.col(text_column).cast("string")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    search = _Search(texts, size, percent)
    classes = search.classes.select("node", "digest", "first")
    named = classes.join(search.labels(), "node", "left").withColumn("component", F.coalesce("component", "node"))
    return search.prints, materialise(named)


def representatives(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash) of one row of each component, and of the rows without words.

    It is the row of least id, rows without ids last, and of least ``xxhash64`` of the text.
    """
    prints, named = _named(docs, size, percent, id_column, text_column)
    first = named.groupBy("component").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
    return first.union(prints.where("digest is null").select("doc_id", "text_hash").distinct())


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept (it names its component).

    Sets are the distinct shingles of ``size`` words in lower case (A-Z); two documents are
    linked if at least ``percent`` of the union of their sets is shared.
    """
    prints, named = _named(docs, size, percent, id_column, text_column)
    least = named.groupBy("component").agg(F.min("first.doc_id").alias("component_id"))
    of_class = named.join(least, "component").select("digest", "component_id")
    rows = prints.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )

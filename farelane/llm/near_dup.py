"""Operator 4 - MinHash near-duplicates by a chosen-path set similarity join.

A document is the set of its distinct 5-word shingles.  Equal sets are
collapsed first.  Each of ``TREES`` independent trees branches the remaining
sets recursively: a node picks positions of the minwise signature, and its
members go on to one child per choice and token.  Nodes of at most ``LEAF``
members are compared exhaustively; in a larger node every member is compared
with the node's pivot.  If at most ``LEAF`` members then lie outside the node's
largest component, or at most a share of ``DENSE``, they are compared with all
others on the full sets, block by block inside tasks; if more, the node is
branched further.  Other pairs that pass the length bound
and the signature estimate are confirmed on the full shingle sets, and links
are merged into components.  Similar sets share a child with a probability of
at least their similarity at each position, so the trees together reach the
target recall; the number of comparisons follows the number of members, never
the square of a group.

Only fixed-size signatures and the sets of candidates are shuffled.  Texts stay
where they are: a second scan computes the sets of the documents listed in a
bitmap of fixed size.

Defined results: null and word-less texts have an empty set and are linked
with nothing; fewer than five words are one shingle; rows that share an id are
one document with the links of all of them; a null id is linked with nothing
and kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm import bitmap
from farelane.llm import textbytes as tb
from farelane.llm.components import connected_components
from farelane.llm.frames import arrow_map, materialize

SHINGLE = 5
THRESHOLD = 75  # percent
TOKENS = 48  # minwise tokens of a signature
TREES = 4
LEAF = 8
#: children of a node below the root, and tokens that each of them takes at once
CHILDREN = 3
STEP = 3
#: pairs whose signatures agree on less than this share of tokens are not confirmed: three standard deviations below the threshold
MIN_AGREE = 0.75 - 3 * (0.75 * 0.25 / TOKENS) ** 0.5
#: nodes that are still large at this depth are compared exhaustively
MAX_DEPTH = 5
#: a large node is dense if at most this share of its members lies outside its largest component; what lies outside is then
#: compared with all members on the full sets
DENSE = 0.3
BLOCK = 1024

_rng = np.random.default_rng(4)
_MULTIPLY = _rng.integers(1, 1 << 62, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 62, TOKENS, dtype=np.uint64)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes row by row, index where each row begins)."""
    n_rows = len(offsets) - 1
    _, _, _, hashes, first = tb.words(raw, offsets, tb.NOT_SPACE)
    parts = [tb.shingles(hashes, first, k)]
    counts = np.diff(first)
    for size in range(1, k):  # short texts are one shingle
        short = np.flatnonzero(counts == size)
        if len(short):
            at = first[short]
            acc = np.full(len(short), size, np.uint64)
            for j in range(size):
                acc += hashes[at + j] * np.uint64(tb._STEP[j + 8])
            parts.append((at, short, tb.mix(acc)))
    row = np.concatenate([p[1] for p in parts])
    sh = np.concatenate([p[2] for p in parts])
    order = np.argsort(sh)
    order = order[np.argsort(row[order].astype(np.uint16) if n_rows < 1 << 16 else row[order], kind="stable")]
    row, sh = row[order], sh[order]
    new = np.ones(len(sh), bool)
    new[1:] = (row[1:] != row[:-1]) | (sh[1:] != sh[:-1])
    row, sh = row[new], sh[new]
    return sh, np.searchsorted(row, np.arange(n_rows + 1))


def _signatures(docs: DataFrame, k: int) -> DataFrame:
    """id, n (set size), f1 and f2 (fingerprint of the set), sig (the minwise tokens); documents with a set and an id."""

    def run(batch):
        ids = batch.column(0)
        for lo, hi, raw, off in tb.text_groups(batch, "text"):
            sh, first = shingle_sets(raw, off, k)
            n = np.diff(first)
            full = np.flatnonzero(n)
            begin = first[full]
            sig = np.zeros((hi - lo, TOKENS), np.uint32)
            f = np.zeros((2, hi - lo), np.uint64)
            if len(full):
                for t in range(TOKENS):
                    v = ((sh * _MULTIPLY[t] + _ADD[t]) >> np.uint64(32)).astype(np.uint32)
                    sig[full, t] = np.minimum.reduceat(v, begin)
                f[0, full] = np.add.reduceat(tb.mix(sh ^ np.uint64(0x5851F42D4C957F2D)), begin)
                f[1, full] = np.add.reduceat(tb.mix(sh + np.uint64(0x14057B7EF767814F)), begin)
            data = sig.astype("<u4").tobytes()
            size = 4 * TOKENS
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(lo, hi - lo),
                    pa.array(n.astype(np.int64)),
                    pa.array(f[0].view(np.int64)),
                    pa.array(f[1].view(np.int64)),
                    pa.array([data[size * i : size * (i + 1)] if n[i] else None for i in range(hi - lo)], pa.binary()),
                ],
                names=["id", "n", "f1", "f2", "sig"],
            )

    return arrow_map(docs.select("id", "text"), run, "id bigint, n bigint, f1 bigint, f2 bigint, sig binary")


def _sets(docs: DataFrame, wanted, k: int) -> DataFrame:
    """id, items (the sorted shingle hashes) of the documents in the bitmap."""

    def run(batch):
        keep = bitmap.listed(wanted.value, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
        batch = batch.filter(pa.array(keep))
        ids = batch.column(0)
        for lo, hi, raw, off in tb.text_groups(batch, "text"):
            sh, first = shingle_sets(raw, off, k)
            items = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sh.view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), items], names=["id", "items"])

    src = docs.filter(F.col("id").isNotNull()).select("id", "text", F.xxhash64("id").alias("h"))
    return arrow_map(src, run, "id bigint, items array<bigint>")


def _token(position) -> F.Column:
    return F.substring("sig", position * 4 + 1, F.lit(4))


def _roots(reps: DataFrame, trees: int) -> DataFrame:
    """node, id: the children of each tree's root, two chosen positions per tree."""
    chosen = np.random.default_rng(12).permutation(TOKENS)
    nodes = []
    for t in range(trees):
        for p in chosen[[2 * t % TOKENS, (2 * t + 1) % TOKENS]].tolist():
            nodes.append(F.xxhash64(F.lit(t), F.lit(p), _token(F.lit(p))))
    return reps.select("id", F.explode(F.array(*nodes)).alias("node"))


def _children(entries: DataFrame, reps: DataFrame) -> DataFrame:
    """``CHILDREN`` children of each entry, each under ``STEP`` tokens at positions that the node decides."""
    keys = []
    for j in range(CHILDREN):
        places = [F.pmod(F.xxhash64("node", F.lit(j), F.lit(i)), F.lit(TOKENS)).cast("int") for i in range(STEP)]
        keys.append(F.xxhash64("node", F.lit(j), *[_token(p) for p in places]))
    chosen = entries.join(reps.select("id", "sig"), "id")
    return chosen.select("id", F.explode(F.array(*keys)).alias("node"))


def _shared(entries: DataFrame, leaf: int) -> DataFrame:
    """The entries of nodes with at least two members, with the node's size and, in a large node, its pivot.

    The pivot is the member that is in most large nodes, so one that most
    members of a dense group resemble.
    """
    sizes = entries.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
    shared = materialize(entries.join(sizes, "node"), "nodes")
    big = shared.filter(F.col("size") > leaf)
    often = big.groupBy("id").agg(F.count("*").alias("often"))
    pivots = big.join(often, "id").groupBy("node").agg(F.max(F.struct("often", F.xxhash64("id"), "id")).alias("p"))
    return shared.join(pivots.select("node", F.col("p.id").alias("pivot")), "node", "left")


def _node_pairs(shared: DataFrame, leaf: int) -> DataFrame:
    """a < b: all pairs of the small nodes, and every other member of a large node with its pivot."""
    small = shared.filter(F.col("size") <= leaf).select("node", "id")
    other = small.select("node", F.col("id").alias("other"))
    inside = small.join(other, "node").filter(F.col("id") < F.col("other")).select(F.col("id").alias("a"), F.col("other").alias("b"))
    star = shared.filter((F.col("size") > leaf) & (F.col("id") != F.col("pivot")))
    return inside.union(star.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")))


def _candidates(pairs: DataFrame, reps: DataFrame, threshold: int) -> DataFrame:
    """a, b, set sizes, agree: the pairs that pass the length bound and the signature estimate."""
    left = reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    right = reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    fits = 100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb")
    same = F.lit(0)
    for t in range(TOKENS):
        same = same + (F.substring("sa", 4 * t + 1, 4) == F.substring("sb", 4 * t + 1, 4)).cast("int")
    both = pairs.distinct().join(left, "a").join(right, "b").filter(fits).select("a", "b", "na", "nb", same.alias("agree"))
    return both.filter(F.col("agree") >= MIN_AGREE * TOKENS)


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("ib"))
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("ia"))
    n = F.size(F.array_intersect("ia", "ib"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "na", "nb", n.alias("n"))
    return both.filter(100 * F.col("n") >= threshold * (F.col("na") + F.col("nb") - F.col("n"))).select("a", "b")


def _unresolved(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs whose ends are not yet known to be connected."""
    if labels is None:
        return pairs
    la = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    lb = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    both = pairs.join(la, "a", "left").join(lb, "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components after more links: only the links between components are followed."""
    if labels is None:
        return materialize(connected_components(links), "components")
    la = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    lb = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    between = links.join(la, "a", "left").join(lb, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = materialize(connected_components(between), "component_links")
    old = labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("wider")), "component", "left")
    old = old.select("node", F.coalesce("wider", "component").alias("component"))
    new = joined.join(labels.select("node"), "node", "left_anti").select("node", "component")
    return materialize(old.union(new), "components")


def _open_nodes(shared: DataFrame, labels: DataFrame | None, leaf: int) -> DataFrame:
    """node, id, component, major, rest, all of the large nodes that hold several components; ``rest`` of ``all`` members are outside the largest one."""
    big = shared.filter(F.col("size") > leaf).select("node", "id")
    if labels is None:
        named = big.withColumn("component", F.col("id"))
    else:
        of = labels.select(F.col("node").alias("id"), "component")
        named = big.join(of, "id", "left").select("node", "id", F.coalesce("component", "id").alias("component"))
    counts = named.groupBy("node", "component").agg(F.count("*").alias("n"))
    nodes = counts.groupBy("node").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
    nodes = nodes.select("node", F.col("top.component").alias("major"), (F.col("all") - F.col("top.n")).alias("rest"), "all")
    return named.join(nodes.filter("rest > 0"), "node")


def _facing_links(opened: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """a < b: links on full sets between members of different components of a node.

    Each member outside a node's largest component is compared with every
    member of another component.  Both sides are cut into blocks of about
    ``BLOCK`` members; the pairs of two blocks stay inside a task, which returns
    only links that join components not yet joined there, so fewer than it has
    components, however many pairs are alike.
    """

    def blocks(n):
        return F.ceil(F.col(n) / BLOCK).cast("int")

    def salt(n, seed):
        return F.pmod(F.xxhash64("id", F.lit(seed)), blocks(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), blocks(n) - 1))

    full = opened.join(sets.filter(F.size("items") > 0).select("id", "items"), "id")
    left = full.select("node", salt("all", 1).alias("x"), every("rest").alias("y"), "id", "component", "items")
    few = full.filter(F.col("component") != F.col("major")).select("node", every("all").alias("x"), salt("rest", 2).alias("y"), "id", "component", "items")
    right = few.select(*[F.col(c).alias(c) for c in few.columns])  # columns of their own, since both sides come from one table

    def compare(members: pa.Table, few: pa.Table) -> pa.Table:
        def read(t):
            sizes = t["items"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            return t["id"].to_numpy(), t["component"].to_numpy(), sizes, tb.prefix(sizes), t["items"].combine_chunks().flatten().to_numpy()

        out = []
        if len(members) and len(few):
            ids, comps, sizes, first, items = read(members)
            codes, items = np.unique(items, return_inverse=True)
            joined: dict[int, int] = {}

            def root(c: int) -> int:
                while joined.get(c, c) != c:
                    joined[c] = c = joined.get(joined[c], joined[c])
                return c

            its_ids, its_comps, its_sizes, its_first, its_items = read(few)
            for i, c, n, lo in zip(its_ids.tolist(), its_comps.tolist(), its_sizes.tolist(), its_first[:-1].tolist(), strict=True):
                mine = its_items[lo : lo + n]
                at = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
                mark = np.zeros(len(codes), np.int64)
                mark[at[codes[at] == mine]] = 1
                both = np.add.reduceat(mark[items], first[:-1])
                alike = np.flatnonzero((comps != c) & (100 * both >= threshold * (sizes + n - both)))
                for j in alike[np.unique(comps[alike], return_index=True)[1]].tolist():
                    one, other = root(c), root(int(comps[j]))
                    if one != other:
                        joined[max(one, other)] = min(one, other)
                        out.append((min(i, int(ids[j])), max(i, int(ids[j]))))
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    keys = ["node", "x", "y"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "a bigint, b bigint")


def _facing(opened: DataFrame, reps: DataFrame, threshold: int, most: int | None = None) -> DataFrame:
    """a < b: each member outside a node's largest component with every member of another component that passes the length bound and the signature estimate.

    Both sides are cut into blocks of about ``BLOCK`` members; with ``most``
    only so many of each block, those whose signatures agree most.  ``components`` no
    longer asks for these pairs: their number grows with the square of a group.
    """

    def blocks(n):
        return F.ceil(F.col(n) / BLOCK).cast("int")

    def salt(n, seed):
        return F.pmod(F.xxhash64("id", F.lit(seed)), blocks(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), blocks(n) - 1))

    full = opened.join(reps.select("id", "n", "sig"), "id")
    left = full.select("node", salt("all", 1).alias("x"), every("rest").alias("y"), "id", "component", "n", "sig")
    few = full.filter(F.col("component") != F.col("major")).select("node", every("all").alias("x"), salt("rest", 2).alias("y"), "id", "component", "n", "sig")
    right = few.select(*[F.col(c).alias(c) for c in few.columns])  # columns of their own, since both sides come from one table

    def compare(members: pa.Table, few: pa.Table) -> pa.Table:
        def read(t):
            sig = np.frombuffer(b"".join(t["sig"].to_pylist()), "<u4").reshape(len(t), TOKENS)
            return t["id"].to_numpy(), t["component"].to_numpy(), t["n"].to_numpy(), sig

        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(members) and len(few):
            ids, comps, sizes, sigs = read(members)
            for i, c, n, sig in zip(*read(few), strict=True):
                agree = (sigs == sig).sum(1)
                fits = (agree >= MIN_AGREE * TOKENS) & (comps != c) & (100 * np.minimum(sizes, n) >= threshold * np.maximum(sizes, n))
                best = np.flatnonzero(fits)
                if most is not None:
                    best = best[np.argsort(-agree[best], kind="stable")[:most]]
                out_a.append(np.minimum(ids[best], i))
                out_b.append(np.maximum(ids[best], i))
        return pa.table({"a": pa.array(np.concatenate(out_a), pa.int64()), "b": pa.array(np.concatenate(out_b), pa.int64())})

    keys = ["node", "x", "y"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "a bigint, b bigint")


def _together(tables: list[DataFrame]) -> DataFrame:
    """One scan of tables that were written with the same columns."""
    if len(tables) == 1:
        return tables[0]
    folders = sorted({f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()})
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*folders)


def _some(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles`` and ``component_id``, the smallest id reachable over links."""
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = materialize(_signatures(src, shingle), "signatures")
    full = rows.filter((F.col("n") > 0) & F.col("id").isNotNull())
    groups = materialize(full.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")), "equal_sets")
    # the links of equal sets join the documents of one id that has several texts, too
    reps = full.join(groups, (full["id"] == groups["rep"]) & (full["n"] == groups["n"]) & (full["f1"] == groups["f1"]) & (full["f2"] == groups["f2"]))
    reps = materialize(reps.select("id", full["n"], "sig").distinct(), "representatives")

    labels: DataFrame | None = None
    sets: list[DataFrame] = []  # written tables of disjoint documents
    seen: list[DataFrame] = []

    def fetch(ids: DataFrame) -> None:
        """Write the sets of the documents that have none written yet."""
        # the ids are written before they are looked up, or the look-up would run over the pairs
        ids = materialize(ids.distinct(), "ends")
        if sets:
            ids = materialize(ids.join(_together(sets).select("id"), "id", "left_anti"), "new_ends")
        wanted = bitmap.collect(ids.select(F.xxhash64("id").alias("h")), "h")
        if wanted.any():
            listed = sc.broadcast(wanted)
            sets.append(materialize(_sets(src, listed, shingle).join(ids, "id", "left_semi"), "sets"))
            listed.unpersist()

    def follow(pairs: DataFrame, best_first: bool = False) -> None:
        """Confirm the pairs that are new and still apart, and merge their links."""
        nonlocal labels
        pairs = pairs.distinct()
        if seen:
            pairs = pairs.join(_together(seen).select("a", "b"), ["a", "b"], "left_anti")
        pairs = materialize(_unresolved(_candidates(pairs, reps, threshold), labels), "candidates")
        if not _some(pairs):
            return
        seen.append(pairs)
        fetch(pairs.select(F.explode(F.array("a", "b")).alias("id")))
        if not best_first:
            labels = _merged(labels, materialize(_confirm(pairs, _together(sets), threshold), "links"))
        else:  # most links: first every document against its most similar partner, then what is still apart
            best = pairs.groupBy("b").agg(F.max(F.struct("agree", "a", "na", "nb")).alias("p")).select("p.a", "b", "p.na", "p.nb")
            labels = _merged(labels, materialize(_confirm(best, _together(sets), threshold), "links"))
            rest = _unresolved(pairs.join(best.select("a", "b"), ["a", "b"], "left_anti"), labels)
            labels = _merged(labels, materialize(_confirm(rest, _together(sets), threshold), "links"))

    entries, depth = _roots(reps, trees), 0
    while True:
        shared = _shared(entries, leaf)
        follow(_node_pairs(shared, leaf if depth < MAX_DEPTH else 1 << 62), best_first=not depth)
        depth += 1
        if depth > MAX_DEPTH:
            break
        opened = materialize(_open_nodes(shared, labels, leaf), "open_nodes")
        if not _some(opened):
            break
        dense = (F.col("rest") <= leaf) | (F.col("rest") <= DENSE * F.col("all"))
        entries = _children(opened.filter(~dense).select("id", "node"), reps)
        opened = opened.filter(dense)
        if _some(opened):
            fetch(opened.select("id"))
            labels = _merged(labels, materialize(_facing_links(opened, _together(sets), threshold), "links"))
    return _assigned(rows, groups, labels)


def _assigned(rows: DataFrame, groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Every document with the component of its set."""
    of_group = groups.select("n", "f1", "f2", F.col("rep").alias("component"))
    if labels is not None:
        named = labels.select(F.col("node").alias("rep"), F.col("component").alias("wider"))
        of_group = groups.join(named, "rep", "left").select("n", "f1", "f2", F.coalesce("wider", "rep").alias("component"))
    out = rows.select("id", "n", "f1", "f2").join(of_group, ["n", "f1", "f2"], "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("id").isNotNull(), F.col("component")), "id").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the smallest id of each component, in the columns of ``docs``; null ids are kept."""
    found = components(docs, id_col, text_col, **options).filter(F.col("id") != F.col("component_id")).select(F.col("id").alias("__gone")).distinct()
    return docs.join(found, docs[id_col].cast("long") == F.col("__gone"), "left_anti")

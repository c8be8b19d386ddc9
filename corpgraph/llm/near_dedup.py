"""Near-duplicate detection: banded MinHash, odd sketches, exact confirmation, connected components.

* A text's set holds the hashes of its distinct word shingles. Texts with equal
  sets form a class at once; only class representatives go on.
* 128 MinHash samples are cut into 32 bands of 4: a pair at similarity 0.8 shares
  no band with probability (1 - 0.8^4)^32 < 5e-8.
* The samples also flip bits of a 512-bit parity bitmap (an odd sketch). The
  population count of two bitmaps' XOR estimates the similarity precisely when it
  is high; pairs estimated below 0.5 are dropped (over five deviations below 0.8).
* A second bitmap takes one bit from every shingle of the set. Its XOR count is
  never above the size of the sets' symmetric difference, so a count too high for
  the threshold rules a pair out for certain.
* What remains is confirmed on full shingle sets, recomputed from the texts.
* In a band's bucket, members are first held only against one centre (a star), so
  a bucket of n copies costs n checks; the centre is the member that shares most
  buckets, as the original of many copies does. Whoever is still outside the largest
  component of its bucket must still meet the members of other components, so that no
  link that joins two components is missed: in a small bucket all of them, behind the
  bitmaps and once for each pair (in the first bucket that it shares).
* In a larger bucket only those that differ alike from a member of that component, the
  centre. Let D(x) be the symmetric difference of x and the centre. Then |x ^ y| is
  |D(x)| + |D(y)| - 2 |D(x) & D(y)|, and as x does not link with the centre, every y that
  links with x shares elements of D(x), a known number of them or more. Elements are
  ordered by their number in a sample of the bucket, rare ones first; of each D a prefix
  long enough to hold one of that many is joined by element, and a pair goes on if what
  follows its element can still make up the number. The order changes the cost, and
  neither it nor the sample the pairs that link.

Everything up to the last step goes by classes of equal sets, numbered when their
table is written; documents come in again with the components' smallest doc_id.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpgraph.llm import batches
from corpgraph.llm.work import WorkArea, left_join, releasing

BANDS, DEPTH, SKETCH_WORDS = 32, 4, 8
SAMPLES, SKETCH_BITS = BANDS * DEPTH, 64 * SKETCH_WORDS
FULL_WORDS = 16
#: XOR population count up to which a pair is confirmed on full sets: similarity 0.5 as the sketch estimates it.
MOST_ODD = int(SKETCH_BITS * (1 - (1 - 2 / SKETCH_BITS) ** SAMPLES) / 2)
STARS = 2
#: Members of a bucket up to which all of them are met in the last turn; beyond it, those that differ alike from a centre.
SLICE_MEMBERS = 256
#: Members of a centre, about, whose elements are counted to order them.
COUNTED_MEMBERS = 64
_rng = np.random.default_rng(7_2024)
_XOR = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32)[:, None]
_MUL = (_rng.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_BAND_KEYS = _rng.integers(0, 2**63, (BANDS, DEPTH), dtype=np.uint64) | np.uint64(1)
_SAMPLE_KEYS = _rng.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_PIECE = 4096


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` make one shingle, none an empty set."""
    w = batches.Words(raw, offsets, lower=True)
    h = w.hashes()
    at, grams = batches.grams(h, w.count, w.first, width)
    bounds = np.searchsorted(at, w.first)
    whole = batches.row_hash(h, w.first)
    out = []
    for i, n in enumerate(w.count):
        part = grams[bounds[i] : bounds[i + 1]] if n >= width else whole[i : i + 1] if n else grams[:0]
        part = np.sort(part)
        out.append(part[np.append(True, part[1:] != part[:-1])] if len(part) > 1 else part)
    return out


def signature(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and odd sketch of a non-empty set."""
    low = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    short = (values >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), _PIECE):
        np.minimum(low, ((short[None, i : i + _PIECE] ^ _XOR) * _MUL).min(axis=1), out=low)
    wide = low.astype(np.uint64)
    bands = batches.mix((wide.reshape(BANDS, DEPTH) * _BAND_KEYS).sum(axis=1) + np.arange(BANDS, dtype=np.uint64))
    bit = batches.mix(wide + _SAMPLE_KEYS) >> np.uint64(55)
    odd = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1
    every = np.bincount((batches.mix(values) >> np.uint64(54)).astype(np.int64), minlength=64 * FULL_WORDS).astype(np.uint8) & 1
    return bands, np.packbits(np.concatenate([odd, every]), bitorder="little").view(np.uint64)


FEATURES = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>"


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = np.cumsum([0] + [0 if r is None else len(r) for r in rows])
    full = [r.view(np.int64) for r in rows if r is not None]
    values = np.concatenate(full) if full else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values))


def _digests(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two 64-bit digests of each set, of which the first is 0 for the empty set."""
    d1 = np.array([int(s.sum(dtype=np.uint64)) if len(s) else 0 for s in sets], np.uint64)
    d2 = np.array([int(np.bitwise_xor.reduce(batches.mix(s))) if len(s) else 0 for s in sets], np.uint64)
    return [pa.array(batches.mix(d1).view(np.int64)), pa.array(d2.view(np.int64))]


def _features(rows: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for part, raw, offsets in batches.slices(batch, "text"):
            sets = shingle_sets(raw, offsets, width)
            made = [signature(s) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.array([len(s) for s in sets], np.int64)), *_digests(sets), _lists([m[0] for m in made]), _lists([m[1] for m in made])],
                ["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"],
            )


def _sets(rows: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for _, raw, offsets in batches.slices(batch, "text"):
            sets = shingle_sets(raw, offsets, width)
            yield pa.RecordBatch.from_arrays([*_digests(sets), pa.array([s.tobytes() for s in sets], pa.binary())], ["d1", "d2", "members"])


def _confirm(rows: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        keep = np.zeros(batch.num_rows, bool)
        for i, (a, b) in enumerate(zip(batch.column("left_members"), batch.column("right_members"), strict=True)):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _full_sets(docs: DataFrame, classes: DataFrame, needed: DataFrame, area: WorkArea, name: str, width: int) -> DataFrame:
    """class, members: the full sets of the classes ``needed``, one row each."""
    of = area.save(classes.join(needed, "class", "left_semi").select("class", "d1", "d2", "rep"), f"{name}-of")
    texts = docs.join(of.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    sets = texts.mapInArrow(releasing(_sets, width=width), "d1 long, d2 long, members binary").dropDuplicates(["d1", "d2"])
    return area.save(sets.join(of.select("d1", "d2", "class"), ["d1", "d2"]).select("class", "members"), f"{name}-sets")


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, area: WorkArea, name: str, width: int, percent: int) -> DataFrame:
    """Those (a, b) of ``pairs`` of classes whose full sets are similar enough; b is the centre in a star.

    The members of a are fetched first, one row a pair; a centre's set then comes to
    them, so that only its own row is shuffled, whatever the number of its pairs.
    """
    needed = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    members = _full_sets(docs, classes, needed, area, name, width)
    left = members.select(F.col("class").alias("a"), F.col("members").alias("left_members"))
    right = members.select(F.col("class").alias("b"), F.col("members").alias("right_members"))
    links = area.save(pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(releasing(_confirm, percent=percent), "a long, b long"), f"{name}-links")
    area.drop(f"{name}-sets", f"{name}-of")
    return links


def _counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements that two or more of a centre's counted sets hold, with their numbers, and the number of sets."""
    for batch in rows:
        made = []
        for sets in batch.column("counted"):
            values, n = np.unique(np.concatenate([np.frombuffer(m.as_buffer(), np.uint64) for m in sets.values]), return_counts=True)
            made.append((values[n > 1].tobytes(), n[n > 1].astype(np.int64).tobytes(), len(sets.values)))
        yield pa.RecordBatch.from_arrays([batch.column("b"), *(pa.array([m[i] for m in made], t) for i, t in enumerate((pa.binary(), pa.binary(), pa.int64())))], ["b", "values", "numbers", "counted"])


DIFFERENCES = "a long, b long, label long, n long, d long, e long, link boolean, asked array<long>, listed array<long>"


def _difference(x: np.ndarray, centre: np.ndarray, values: np.ndarray, numbers: np.ndarray, counted: int) -> np.ndarray:
    """Elements of one of two sets, those that few differences of the counted sets hold first."""
    both = np.concatenate([x, centre])
    both.sort()
    twice = np.append(False, both[1:] == both[:-1])
    out = both[~(twice | np.append(twice[1:], False))]
    if not len(values):
        return out
    at = np.minimum(np.searchsorted(values, out), len(values) - 1)
    held = np.where(values[at] == out, numbers[at], 0)
    lost = centre[np.minimum(np.searchsorted(centre, out), len(centre) - 1)] == out
    return out[np.argsort(np.where(lost, counted - held, held), kind="stable")]


def prefixes(n: int, d: int, centre: int, percent: int) -> tuple[int, int, int]:
    """e of a set of ``n`` elements, ``d`` of them and the centre's apart, and the lengths of the prefixes that it asks for and is listed by.

    Sets x, y link when 2 * (100 + percent) * |D(x) & D(y)| >= e(x) + e(y). No e is less
    than -(100 - percent) * |centre|, and e is above (100 - percent) * |centre| where a
    set does not link with the centre, as whoever asks. Of linked sets none lacks more
    than (100 - percent) / percent of its own size.
    """
    p, q = 100 + percent, 100 - percent
    e, most = p * d - q * n, q * n // percent + 1
    asks, lists = (max(1, -(-need // (2 * p))) for need in (e - q * centre, e + q * centre + 1))
    return e, max(0, min(d - asks + 1, most)), max(0, min(d - lists + 1, most))


def _differences(rows: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        made, asked, listed = [], [], []
        for r in zip(*(batch.column(k) for k in ("left_members", "right_members", "values", "numbers")), batch.column("counted").to_pylist(), batch.column("outside").to_pylist(), strict=True):
            x, c, values = (np.frombuffer(v.as_buffer(), np.uint64) if v.is_valid else np.zeros(0, np.uint64) for v in r[:3])
            numbers = np.frombuffer(r[3].as_buffer(), np.int64) if r[3].is_valid else np.zeros(0, np.int64)
            diff = _difference(x, c, values, numbers, r[4] or 0)
            e, asks, lists = prefixes(len(x), len(diff), len(c), percent)
            like = e <= (100 - percent) * len(c)
            made.append((len(x), len(diff), e, r[5] and like))
            asked.append(diff[:asks] if r[5] and not like else None)
            listed.append(diff[:lists])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in ("a", "b", "label")), *(pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_()))), _lists(asked), _lists(listed)],
            ["a", "b", "label", "n", "d", "e", "link", "asked", "listed"],
        )


def _alike_apart(docs: DataFrame, classes: DataFrame, placed: DataFrame, area: WorkArea, name: str, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of different labels that share a bucket of ``placed`` (bucket, class, label, main, shares) and may link.

    Where a class links with its bucket's centre, that pair stands for all its pairs with
    others that do, or that are in the centre's component. A pair may come several times.
    """
    centres = placed.where("label = main").groupBy("bucket").agg(F.max_by("class", F.struct("shares", "class")).alias("b"))
    around = area.save(placed.join(centres, "bucket").where("class <> b").select(F.col("class").alias("a"), "b", "label", (F.col("label") != F.col("main")).alias("outside")).distinct(), f"{name}-around")
    needed = around.select(F.col("a").alias("class")).union(around.select(F.col("b").alias("class"))).distinct()
    members = _full_sets(docs, classes, needed, area, name, width)
    left = members.select(F.col("class").alias("a"), F.col("members").alias("left_members"))
    right = members.select(F.col("class").alias("b"), F.col("members").alias("right_members"))
    parts = around.groupBy("b").agg(F.ceil(F.count("*") / COUNTED_MEMBERS).alias("of"))
    some = around.join(parts, "b").where("pmod(xxhash64(a), of) = 0").select("a", "b").join(left, "a")
    counts = some.groupBy("b").agg(F.collect_list("left_members").alias("counted")).mapInArrow(releasing(_counts), "b long, values binary, numbers binary, counted long")
    right = area.save(right.join(around.select("b").distinct(), "b", "left_semi").join(counts, "b", "left"), f"{name}-centres")
    rows = area.save(around.join(left, "a").join(right, "b").mapInArrow(releasing(_differences, percent=percent), DIFFERENCES), f"{name}-differences")

    def elements(side: str, prefixes: str) -> DataFrame:
        one = rows.select("b", F.col("a").alias(f"{side}_class"), *(F.col(k).alias(f"{side}_{k}") for k in ("label", "n", "d", "e")), F.posexplode(prefixes).alias("at", "element"))
        return one.withColumn(f"{side}_left", F.col(f"{side}_d") - F.col("at")).drop("at", f"{side}_d")

    able = (F.col("x_label") != F.col("y_label")) & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
    able &= 2 * (100 + percent) * F.least("x_left", "y_left") >= F.col("x_e") + F.col("y_e")
    met = elements("x", "asked").join(elements("y", "listed"), ["b", "element"]).where(able).select(F.col("x_class").alias("a"), F.col("y_class").alias("b"))
    found = met.union(rows.where("link").select("a", "b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def components(links: DataFrame, area: WorkArea, name: str) -> DataFrame:
    """node, label: the smallest node of each node's connected component, for all nodes of ``links`` (a, b).

    Each step takes the least label around a node and then that label's own label,
    so paths halve; it ends when no label changes.
    """
    edges = area.save(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), f"{name}-edges")
    labels = area.save(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = edges.join(labels, edges.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        pulled = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        up = labels.select(F.col("node").alias("mid"), F.col("label").alias("top"))
        new = area.save(pulled.join(up, "mid", "left").select("node", "old", F.least("mid", F.coalesce("top", "mid")).alias("label")), f"{name}-{step}")
        changed = not new.where("old <> label").isEmpty()
        labels = new.select("node", "label")
        if step > 1:
            area.drop(f"{name}-{step - 2}")
        if not changed:
            return labels


def _odd_bits(a: str, b: str, first: int, words: int) -> Column:
    return functools.reduce(Column.__add__, [F.bit_count(F.element_at(a, i + 1).bitwiseXOR(F.element_at(b, i + 1))) for i in range(first, first + words)])


def _possible(x: str, y: str, percent: int) -> Column:
    """Whether sizes and bitmaps of two rows allow the similarity."""
    n = [F.col(f"{x}n"), F.col(f"{y}n")]
    sketch = (f"{x}sketch", f"{y}sketch")
    return (100 * F.least(*n) >= percent * F.greatest(*n)) & ((100 + percent) * _odd_bits(*sketch, SKETCH_WORDS, FULL_WORDS) <= (100 - percent) * (n[0] + n[1])) & (_odd_bits(*sketch, 0, SKETCH_WORDS) <= MOST_ODD)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts (A-Z in lower case, words between ASCII blanks) link when
    100 * intersection >= ``percent`` * union of their sets of ``width``-word
    shingles; ``percent`` must be 80 or more for the bands' recall. component_id is
    the smallest doc_id reachable over links; kept marks that document itself.

    Null and empty texts, and texts without words, have empty sets and link with
    nothing. Rows with a null id link with nothing and stay, with a null
    component_id. Rows that repeat an id are one document: their texts are linked.
    Empty tables give no rows. Other columns are not read. Very long texts are taken
    whole.
    """
    if percent < 80:
        raise ValueError("percent must be 80 or more: the bands are laid out for that")
    area = WorkArea(docs.sparkSession, "near-dedup")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    feats = area.save(texts.mapInArrow(releasing(_features, width=width), FEATURES), "features")

    known = feats.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("d1", "d2").agg(F.count("*").alias("rows"), F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = area.save(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    rows = classes.select("class", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least <> most").select("bucket")
    crowded = area.save(rows.join(shared, "bucket", "left_semi").distinct(), "crowded")
    # Texts of one id are one document: its classes are linked to the least of them.
    known_ids = known.groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("lo"), F.max(F.struct("d1", "d2")).alias("hi")).where("lo <> hi")
    same_id = known.select("doc_id", "d1", "d2").join(known_ids.select("doc_id"), "doc_id", "left_semi").distinct().join(classes.select("d1", "d2", "class"), ["d1", "d2"])
    least = same_id.groupBy("doc_id").agg(F.min("class").alias("a"))
    links = area.save(same_id.join(least, "doc_id").select("a", F.col("class").alias("b")).where("a <> b").distinct(), "links-id")

    sizes = crowded.groupBy("bucket").count()
    busy = sizes.join(crowded, "bucket").groupBy("class").agg(F.sum("count").alias("shares"))
    crowded = area.save(crowded.join(busy, "class"), "members")
    info = area.save(classes.join(crowded.select("class").distinct(), "class", "left_semi").select("class", "n", "sketch", "bands"), "info")
    area.drop("crowded")

    def described(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and bitmaps allow the similarity."""
        left, right = (info.select(F.col("class").alias(k), F.col("n").alias(f"{k}_n"), F.col("sketch").alias(f"{k}_sketch")) for k in "ab")
        return pairs.join(left, "a").join(right, "b").where(_possible("a_", "b_", percent)).select("a", "b")

    labels, tried = None, None
    for turn in range(STARS + 1):
        # What a turn's plan reads several times is a table, so that plans (which the driver holds, with all their tasks) stay small.
        placed = crowded.withColumn("label", F.col("class"))
        if labels is not None:
            placed = area.save(crowded.join(labels, F.col("class") == F.col("node"), "left").select("bucket", "class", "shares", F.coalesce("label", "class").alias("label")), f"placed-{turn}")
        centre = F.max_by(F.struct("class", "label"), F.struct(F.xxhash64("class") if turn else F.col("shares"), "class"))
        mixed = placed.groupBy("bucket").agg(F.count("*").alias("size"), F.min("label").alias("least"), F.max("label").alias("most"), centre.alias("centre")).where("least <> most")
        mixed = area.save(mixed.select("bucket", "size", F.col("centre.class").alias("centre"), F.col("centre.label").alias("centre_label")), f"mixed-{turn}")
        if mixed.isEmpty():
            break
        if turn < STARS:
            pairs = placed.join(mixed, "bucket").where("label <> centre_label").select(F.col("class").alias("a"), F.col("centre").alias("b")).distinct()
            pairs = described(pairs)
        else:
            # Only members outside their bucket's largest component are held against others.
            per = placed.groupBy("bucket", "label").count().groupBy("bucket").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
            full = area.save(placed.join(mixed.select("bucket", "size"), "bucket").join(per, "bucket").select("bucket", "class", "shares", "label", "main", "size"), f"full-{turn}")
            x = full.where(F.col("size") <= SLICE_MEMBERS).join(info, "class").alias("x")
            y = x.where("label <> main").alias("y")
            shared = F.filter(F.zip_with("x.bands", "y.bands", lambda p, q: F.when(p == q, p)), lambda p: p.isNotNull())
            cond = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") != F.col("y.label")) & _possible("x.", "y.", percent) & (F.element_at(shared, 1) == F.col("x.bucket"))
            pairs = x.join(y, cond).select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b"))
            large = full.where(F.col("size") > SLICE_MEMBERS)
            if not large.isEmpty():
                pairs = pairs.union(area.save(described(_alike_apart(texts, classes, large, area, f"apart-{turn}", width, percent).distinct()), f"apart-{turn}"))
                area.drop(*(f"apart-{turn}-{k}" for k in ("around", "of", "sets", "centres", "differences")))
            pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_anti")
        pairs = area.save(pairs, f"pairs-{turn}")
        area.drop(f"placed-{turn}", f"mixed-{turn}", f"full-{turn}", f"apart-{turn}")
        if pairs.isEmpty() and turn:
            if turn < STARS:
                continue
            break
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = links.unionByName(_confirmed(texts, classes, pairs, area, f"turn-{turn}", width, percent))
        labels = components(links, area, f"components-{turn}")
    if labels is None:
        labels = components(links, area, "components")

    led = classes.select("d1", "d2", "class", "rep", "rows").join(labels, F.col("class") == F.col("node"), "left").withColumn("label", F.coalesce("label", "class"))
    joined = led.where("node is not null")
    first = joined.groupBy("label").agg(F.min("rep").alias("first"))
    lead = joined.join(first, "label").select("d1", "d2", F.col("first").alias("component"), "rows").unionByName(led.where("node is null").select("d1", "d2", F.col("rep").alias("component"), "rows"))
    out = left_join(known.select("doc_id", "n_shingles", "d1", "d2"), lead, ["d1", "d2"], "rows", feats.count()).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    own = feats.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(own).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that ``near_duplicates`` doesn't keep; all columns stay."""
    gone = near_duplicates(docs, id_col=id_col, text_col=text_col, width=width, percent=percent).where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti")

"""Exact Jaccard self-join of word shingle sets by partition-and-enumerate signatures, down to components."""

from __future__ import annotations

from collections import OrderedDict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsledger.llm.arrow import frees_memory, slices
from opsledger.llm.components import components
from opsledger.llm.shingles import mixed, shingle_set
from opsledger.session import drop_finished_shuffles, remove_folder, run_folder, stored

_NONE = np.empty(0, np.uint64)
#: Groups of up to this many candidates are checked pair by pair, and those of up to the second as one matrix, unless
#: their sets have more elements than the third together.
SMALL, MATRIX, ELEMENTS = 16, 2048, 4_000_000


class Bands:
    """Size bands of a similarity limit ``percent`` / 100 and the signatures of a set in each.

    Two sets of at most ``top`` elements with that similarity differ in at most ``k`` elements. The feature domain is
    hashed to groups; with tolerance 1 a group has three parts of which two are taken (every subset of two gives a
    signature), with tolerance 0 it has one. As there are more groups than ``k`` differences can spoil, one subset
    agrees in both sets. A few spare groups pay for subsets that are empty in both. An empty subset is signed only by a
    set whose other subsets its possible differences could all spoil, since very many sets may share it. So each linked
    pair shares a signature, whatever its contents.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.tops = [6]

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(self.tops[-1] * 3 // 2)
        return next(i for i, top in enumerate(self.tops) if top >= size)

    @lru_cache(maxsize=512)
    def shape(self, band: int) -> tuple[int, int, int, int]:
        """Differences ``k``, tolerance of a group, number of groups, spare groups."""
        k = 2 * (100 - self.percent) * self.tops[band] // (100 + self.percent)
        tolerance = 1 if k < 32 else 0
        needed = k // (tolerance + 1) + 1
        spare = 1 + k // 12
        return k, tolerance, needed + spare, spare

    def differences(self, size: int, band: int) -> int:
        """The most elements in which a set of ``size`` elements differs from any linked set that it meets in ``band``."""
        partner = min(self.tops[band], size * 100 // self.percent)
        return (100 - self.percent) * (size + partner) // (100 + self.percent)

    def signatures(self, u: np.ndarray) -> np.ndarray:
        """64-bit signatures of the set of hashes ``u``; the larger set of a pair decides the band they meet in.

        To spoil a group takes a difference more than its tolerance, but no more than it has parts that are not empty: the
        subsets without them are empty. If all groups together take more than the set's own possible differences, a
        linked set agrees with it in a subset that is not empty, so neither needs the empty ones.
        """
        found = []
        if len(u) == 0:
            return _NONE
        for band in range(self.band(len(u)), self.band(len(u) * 100 // self.percent) + 1):
            tolerance, groups = self.shape(band)[1:3]
            differences = self.differences(len(u), band)
            if differences == 0:
                continue
            parts = groups * (3 if tolerance else 1)
            spread = mixed(u + np.uint64((band * 2 + 1) * 0xD1342543DE82EF95 % (1 << 64)))
            place = (spread >> np.uint64(20)) % np.uint64(parts)
            sums = np.zeros(parts, np.uint64)
            np.add.at(sums, place, spread)
            counts = np.bincount(place.astype(np.intp), minlength=parts)
            spoiled_by = int(np.minimum((counts > 0).reshape(groups, -1).sum(axis=1), tolerance + 1).sum())
            if tolerance:
                sums, counts = sums.reshape(groups, 3), counts.reshape(groups, 3)
                sums = np.stack([sums[:, 0] + sums[:, 1], sums[:, 0] + sums[:, 2], sums[:, 1] + sums[:, 2]])
                counts = np.stack([counts[:, 0] + counts[:, 1], counts[:, 0] + counts[:, 2], counts[:, 1] + counts[:, 2]])
            sums, counts = sums.ravel(), counts.ravel()
            tags = np.arange(len(sums), dtype=np.uint64) + np.uint64(band << 32)
            signed = mixed(sums + mixed(tags * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)))
            found.append(signed if spoiled_by <= differences else signed[counts > 0])
        return np.concatenate(found) if found else _NONE


    def fine_signatures(self, u: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(band, ``keep``, signatures) with four groups per possible difference, one signature for every group.

        Linked sets agree in all but ``k`` of the groups, empty ones included. So of each set the ``keep`` = ``k`` + 1
        signatures that are rarest in the corpus suffice: linked sets share one of those.
        """
        found = []
        for band in range(self.band(len(u)), self.band(len(u) * 100 // self.percent) + 1):
            k = self.shape(band)[0]
            if k == 0:
                continue
            parts = 4 * (k + 1)
            spread = mixed(u + np.uint64((band * 2 + 1) * 0xA0761D6478BD642F % (1 << 64)))
            sums = np.zeros(parts, np.uint64)
            np.add.at(sums, (spread >> np.uint64(20)) % np.uint64(parts), spread)
            tags = np.arange(parts, dtype=np.uint64) + np.uint64(band << 32)
            found.append((band, k + 1, mixed(sums + mixed(tags * np.uint64(0xE7037ED1A0B428DB) + np.uint64(1)))))
        return found


def parity_sketch(u: np.ndarray) -> bytes:
    """Parities of the number of elements in cells, four cells or more per element and a power of two of them."""
    cells = 1 << max(11, (4 * len(u) - 1).bit_length())
    place = (mixed(u + np.uint64(0x632BE59BD9B4E019)) % np.uint64(cells)).astype(np.intp)
    return np.packbits((np.bincount(place, minlength=cells) & 1).astype(np.uint8)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """The number of unequal parities: two sets differ in at least as many elements. A larger sketch is folded first."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def signed_sets(docs: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """``k`` (key), ``n`` (set size), 128-bit fingerprint ``h1``, ``h2``, ``sketch`` and ``sigs`` per row of ``docs``.

    A task signs the first row of each set and leaves ``sigs`` of its further copies empty, so a set that a third of
    all rows share is signed once per task and not once per row.
    """
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))

    @frees_memory
    def run(batches):
        bands = Bands(percent)
        signed: set[tuple[int, int]] = set()
        for batch in batches:
            for part in slices(batch, 1):
                n, h1, h2, sketches, sigs = [], [], [], [], []
                for t, no_key in zip(part.column(1).to_pylist(), part.column(0).is_null().to_pylist()):
                    u = shingle_set(t, words)
                    n.append(len(u))
                    h1.append(int(u.sum(dtype=np.uint64)))
                    h2.append(int(mixed(u * np.uint64(0x94D049BB133111EB)).sum(dtype=np.uint64)))
                    sketches.append(parity_sketch(u))
                    again = no_key or (h1[-1], h2[-1]) in signed
                    sigs.append(_NONE if again else bands.signatures(u))
                    if not again:
                        if len(signed) >= 200_000:
                            signed.clear()
                        signed.add((h1[-1], h2[-1]))
                ends = np.cumsum([0, *map(len, sigs)])
                flat = np.concatenate(sigs).view(np.int64) if sigs else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(n, pa.int64()), pa.array(np.array(h1, np.uint64).view(np.int64)),
                    pa.array(np.array(h2, np.uint64).view(np.int64)),
                    pa.array(sketches, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["k", "n", "h1", "h2", "sketch", "sigs"])

    return slim.mapInArrow(run, "k bigint, n bigint, h1 bigint, h2 bigint, sketch binary, sigs array<bigint>")


def near_pairs(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The rows ``a``, ``b`` of ``pairs`` whose sizes and sketches (``rep``, ``n``, ``sketch``) allow the similarity."""
    x, y = (sketches.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
    both = pairs.join(x, "a").join(y, "b").where((100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na")))

    @frees_memory
    def run(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            differ = np.array([least_difference(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))], np.int64)
            yield batch.select([0, 1]).filter(pa.array((100 + percent) * differ <= (100 - percent) * sizes))

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint").distinct()


def linked_pairs(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows ``a``, ``b`` of ``pairs`` whose texts (``k``, ``t``) have the asked similarity."""
    both = pairs.join(texts.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b") \
        .join(texts.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a").select("a", "b", "ta", "tb")

    @frees_memory
    def run(batches):
        recent: OrderedDict[tuple[int, str], np.ndarray] = OrderedDict()
        held = 0

        def shingles(k: int, t: str) -> np.ndarray:
            nonlocal held
            found = recent.get((k, t))
            if found is None:
                found = recent[k, t] = shingle_set(t, words)
                held += len(found)
                while held > 2_000_000 and len(recent) > 1:
                    held -= len(recent.popitem(last=False)[1])
            return found

        for batch in batches:
            for part in slices(batch, 2):
                keep = []
                for a, b, x, y in zip(*(part.column(i).to_pylist() for i in range(4))):
                    u, v = shingles(a, x), shingles(b, y)
                    common = len(np.intersect1d(u, v, assume_unique=True))
                    keep.append(100 * common >= percent * (len(u) + len(v) - common))
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def rare_shared(texts: DataFrame, folder: str, words: int, percent: int) -> DataFrame:
    """``sig``, ``rep`` of the rarest fine signatures of each text (``k``, ``t``), as far as two texts share them.

    Frequencies are counted with partial sums per task; ranking them is work on the signatures of one text at a time.
    """
    @frees_memory
    def run(batches):
        bands = Bands(percent)
        for batch in batches:
            for part in slices(batch, 1):
                rep, keep, band, sigs = [], [], [], []
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for b, n, found in bands.fine_signatures(shingle_set(t, words)):
                        rep.append(k), band.append(b), keep.append(n), sigs.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(band, pa.int32()), pa.array(keep, pa.int32()),
                                                  pa.array(sigs, pa.list_(pa.int64()))], names=["rep", "band", "keep", "sigs"])

    made = stored(texts.mapInArrow(run, "rep bigint, band int, keep int, sigs array<bigint>"), f"{folder}/fine")
    fine = made.select("rep", "band", (F.size("sigs") - F.col("keep")).alias("spare"), F.explode("sigs").alias("sig"))
    # only signatures that several texts hold are written: the others of a text come before them in the order of rarity
    counts = stored(fine.groupBy("sig").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), f"{folder}/fine_counts")
    order = Window.partitionBy("rep", "band").orderBy(F.col("m").desc(), F.col("sig").desc())
    return fine.join(counts, "sig").withColumn("behind", F.row_number().over(order)) \
        .where("behind > spare").select("sig", "rep").distinct()


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4,
                       percent: int = 85) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` (smallest key reachable by links) per row of ``docs``.

    Two rows link when their sets of ``words``-word shingles have a Jaccard similarity of ``percent`` / 100 or more.
    Equal sets form one class, which its smallest key stands for. Classes that share a signature are candidates, and
    only pairs from different components so far are checked: sizes and parity sketches bound their difference from
    below, and what those leave open is decided exactly on the texts. First the smallest class of each group is
    compared with its other members, which joins most copies. In groups of at most ``SMALL`` classes all pairs still
    open follow. Members of larger open groups leave when the sketches allow none of the others as a partner; what is
    left is signed anew with fine signatures, of which each text keeps its rarest, so near copies that are not similar
    enough part company before any pair is made. Groups that are still larger are compared as one matrix up to
    ``MATRIX`` members with ``ELEMENTS`` shingles in all. Of yet larger ones ``SMALL`` pivots from the smallest components
    are checked against the others in a round and then leave; rounds end when no group is open. No link between
    different components is lost and nothing is capped. Stored steps are removed when later ones stand.

    A null or empty text has an empty set and links with nothing. Rows that repeat a key count as one document;
    a row without key gets no component. Very long texts are whole sets like others. An empty table gives an
    empty table. Columns other than key and text are not read.
    """
    spark, folder = docs.sparkSession, run_folder(docs.sparkSession, "jaccard")
    sets = stored(signed_sets(docs, key, text, words, percent), f"{folder}/sets")
    slim = stored(sets.select("k", "n", "h1", "h2"), f"{folder}/slim")
    known_sets = slim.where("n > 0 and k is not null")
    classes = stored(known_sets.groupBy("h1", "h2", "n").agg(F.min("k").alias("rep")), f"{folder}/classes")
    signed = sets.where("n > 0 and k is not null").select("k", "h1", F.explode("sigs").alias("sig"))
    # written first, so the join gets both sides from a shuffle and Spark can split a signature with very many rows
    several = stored(signed.groupBy("sig").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo < hi").select("sig"),
                     f"{folder}/several")
    shared = stored(signed.select("sig", "k").join(several, "sig"), f"{folder}/shared")
    members = stored(shared.join(known_sets.join(classes, ["h1", "h2", "n"]).select("k", "rep"), "k").select("sig", "rep").distinct(),
                     f"{folder}/members")
    drop_finished_shuffles(spark)
    wanted = members.select(F.col("rep").alias("k")).distinct()
    texts = stored(docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
                   .join(wanted, "k", "left_semi"), f"{folder}/texts")
    asked = classes.select("h1", "h2", "n", F.col("rep").alias("k")).join(wanted, "k", "left_semi")
    sketches = stored(sets.select("k", "h1", "h2", "n", "sketch").join(asked, ["k", "h1", "h2", "n"])
                      .select(F.col("k").alias("rep"), "n", "sketch").distinct(), f"{folder}/sketches")
    for name in ("sets", "several", "shared"):
        remove_folder(spark, f"{folder}/{name}")
    drop_finished_shuffles(spark)

    def check(pairs: DataFrame, labels: DataFrame | None, name: str) -> DataFrame | None:
        """The labels after the links among ``pairs`` have joined their components."""
        near = stored(near_pairs(pairs, sketches, percent), f"{folder}/near_{name}")
        links = stored(linked_pairs(near, texts, words, percent), f"{folder}/links_{name}")
        drop_finished_shuffles(spark)
        return labels if links.isEmpty() else _joined_labels(labels, links, f"{folder}/labels_{name}")

    lead = members.groupBy("sig").agg(F.min("rep").alias("a"))
    star = members.join(lead, "sig").where("rep > a").select("a", F.col("rep").alias("b")).distinct()
    labels = check(star, None, "star")
    known, opened = _open_groups(members, labels, sketches, f"{folder}/coarse")
    labels = check(_small_pairs(known, opened), labels, "coarse")
    large = stored(_with_partner(known, opened, sketches, percent), f"{folder}/partnered")
    drop_finished_shuffles(spark)
    members = stored(rare_shared(texts.join(large, "k", "left_semi"), folder, words, percent), f"{folder}/rare")
    for name in ("members", "fine", "fine_counts"):
        remove_folder(spark, f"{folder}/{name}")
    turn = 0
    while not members.isEmpty():
        turn += 1
        known, opened = _open_groups(members, labels, sketches, f"{folder}/fine{turn}")
        matrices = (F.col("m") <= MATRIX) & (F.col("elements") <= ELEMENTS)
        together = stored(_group_links(known, opened.where(matrices), texts, words, percent), f"{folder}/links_groups{turn}")
        if not together.isEmpty():
            labels = _joined_labels(labels, together, f"{folder}/labels_groups{turn}")
        pairs, members = _pivot_pairs(known, opened.where((F.col("m") > SMALL) & ~matrices), SMALL, f"{folder}/fine{turn}")
        labels = check(pairs.union(_small_pairs(known, opened)), labels, f"fine{turn}")
    found = classes
    if labels is not None:
        found = classes.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left") \
            .select("h1", "h2", "n", F.coalesce("label", "rep").alias("rep"))
    result = slim.join(found, ["h1", "h2", "n"], "left")
    return result.select(F.col("k").alias(key), F.col("n").alias("n_shingles"),
                         F.when(F.col("k").isNotNull(), F.coalesce("rep", "k")).alias("component_id"))


def _open_groups(members: DataFrame, labels: DataFrame | None, sketches: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """``members`` (``sig``, ``rep``) with component ``c``, and ``sig``, size ``m`` and number of elements of groups over
    several components."""
    sized = members.join(sketches.select("rep", "n"), "rep")
    if labels is None:
        known = sized.withColumn("c", F.col("rep"))
    else:
        known = sized.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left") \
            .select("sig", "rep", "n", F.coalesce("label", "rep").alias("c"))
    known = stored(known, f"{path}_known")
    opened = known.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("elements"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    return known, stored(opened.where("lo < hi").select("sig", "m", "elements"), f"{path}_opened")


def _with_partner(known: DataFrame, opened: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``k`` of the members of open groups over ``SMALL`` that may have a similar member of another component in their group.

    Groups of up to ``MATRIX`` members are judged by sizes and sketches, folded to about one cell per element: the
    number of unequal parities of two sketches bounds the difference from below. Members of larger groups all stay.
    """
    inside = known.join(opened.where(F.col("m") > SMALL).select("sig", "m"), "sig")
    judged = inside.where(F.col("m") <= MATRIX).select("sig", "rep", "c", "n") \
        .join(folded_sketches(sketches), "rep").select("sig", "rep", "c", "n", "s")

    def partnered(table: pa.Table) -> pa.Table:
        rep, c, n = (table.column(i).to_numpy() for i in (1, 2, 3))
        raw = table.column(4).to_pylist()
        least = min(map(len, raw))
        bits = np.stack([_folded(np.frombuffer(x, np.uint8), least) for x in raw]).view(np.uint64)
        found = np.zeros(len(rep), bool)
        for i in range(len(rep)):
            differ = np.bitwise_count(bits ^ bits[i]).sum(axis=1, dtype=np.int64)
            small, large = np.minimum(n, n[i]), np.maximum(n, n[i])
            found[i] = ((c != c[i]) & ((100 + percent) * differ <= (100 - percent) * (n + n[i])) & (100 * small >= percent * large)).any()
        return pa.table({"k": pa.array(rep[found], pa.int64())})

    return judged.groupBy("sig").applyInArrow(partnered, "k bigint").union(
        inside.where(F.col("m") > MATRIX).select(F.col("rep").alias("k"))).distinct()


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch with its halves added up until it has ``size`` bytes; sizes are powers of two."""
    while len(sketch) > size:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def folded_sketches(sketches: DataFrame) -> DataFrame:
    """``rep`` and ``s``: sketches of a quarter of their size, 64 bytes to 16 KB (folding only weakens their bound)."""
    @frees_memory
    def run(batches):
        for batch in batches:
            made = [_folded(np.frombuffer(x, np.uint8), min(max(64, len(x) // 4), 1 << 14)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["rep", "s"])

    return sketches.select("rep", "sketch").mapInArrow(run, "rep bigint, s binary")


def _pivot_pairs(known: DataFrame, opened: DataFrame, pivots: int, path: str) -> tuple[DataFrame, DataFrame]:
    """Pairs of up to ``pivots`` members of each open group with the members of other components; the members left.

    Pivots come from the components with the fewest members in the group, so stragglers are compared with the bulk
    and leave it, not the other way round. They are picked by aggregation with partial results.
    """
    inside = stored(known.select("sig", "rep", "c").join(opened.select("sig"), "sig"), f"{path}_inside")
    share = stored(inside.groupBy("sig", "c").agg(F.count(F.lit(1)).alias("n")), f"{path}_share")
    ranked = inside.join(share, ["sig", "c"]).withColumn("order", F.col("n").cast("decimal(18,0)") * F.lit("1" + "0" * 19).cast(
        "decimal(20,0)") + F.col("rep").cast("decimal(20,0)"))
    picked = ranked.groupBy("sig", F.pmod(F.xxhash64("rep"), F.lit(pivots)).alias("cell")).agg(F.min("order").alias("order"))
    lead = stored(ranked.join(picked.select("sig", "order"), ["sig", "order"]).select("sig", F.col("rep").alias("p"),
                                                                                     F.col("c").alias("pc")), f"{path}_lead")
    pairs = inside.join(lead, "sig").where("c <> pc").select(F.least("p", "rep").alias("a"), F.greatest("p", "rep").alias("b"))
    rest = inside.join(lead.select("sig", F.col("p").alias("rep")), ["sig", "rep"], "left_anti").select("sig", "rep")
    return pairs.distinct(), stored(rest, f"{path}_rest")


def _group_links(known: DataFrame, opened: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """One link ``a``, ``b`` per pair of linked components within those of the ``opened`` groups that have over ``SMALL`` members.

    The common shingles of all members of such a group are counted by one matrix product, in slices of the shingles
    that two members share, so no row per pair is made.
    """
    rows = known.join(opened.where(F.col("m") > SMALL).select("sig"), "sig") \
        .join(texts.select(F.col("k").alias("rep"), "t"), "rep").select("sig", "rep", "c", "t")

    def links(table: pa.Table) -> pa.Table:
        rep, c = (np.array(table.column(i).to_pylist(), np.int64) for i in (1, 2))
        sets = [shingle_set(t, words) for t in table.column(3).to_pylist()]
        sizes = np.array([len(u) for u in sets])
        names, inverse, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        column = np.cumsum(seen > 1) - 1
        column[seen < 2] = -1
        column, owner = column[inverse], np.repeat(np.arange(len(sets)), sizes)
        common = np.zeros((len(sets), len(sets)), np.float32)
        for lo in range(0, int((seen > 1).sum()), 4096):
            here = (column >= lo) & (column < lo + 4096)
            x = np.zeros((len(sets), 4096), np.float32)
            x[owner[here], column[here] - lo] = 1
            common += x @ x.T
        union = sizes[:, None] + sizes[None, :] - common
        i, j = np.nonzero((100 * common.astype(np.float64) >= percent * union) & (c[:, None] < c[None, :]))
        one = np.unique(np.stack([c[i], c[j]]), axis=1, return_index=True)[1] if len(i) else np.empty(0, np.int64)
        return pa.table({"a": pa.array(rep[i[one]]), "b": pa.array(rep[j[one]])})

    return rows.groupBy("sig").applyInArrow(links, "a bigint, b bigint").distinct()


def _small_pairs(known: DataFrame, opened: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` from different components within the open groups of 2 to ``SMALL`` members."""
    small = known.join(opened.where(F.col("m") <= SMALL).select("sig"), "sig")
    listed = small.groupBy("sig").agg(F.array_sort(F.collect_list(F.struct("rep", "c"))).alias("r"))
    pairs = F.transform("r", lambda x, i: F.transform(F.filter(F.slice("r", i + 2, SMALL), lambda y: y["c"] != x["c"]),
                                                      lambda y: F.struct(x["rep"].alias("a"), y["rep"].alias("b"))))
    return listed.select(F.inline(F.flatten(pairs))).distinct()


def _joined_labels(labels: DataFrame | None, links: DataFrame, path: str) -> DataFrame:
    """Component labels of all vertices linked so far, from the labels before and new links."""
    if labels is None:
        return stored(components(links), path)
    a = labels.select(F.col("v").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("v").alias("b"), F.col("label").alias("lb"))
    between = links.join(a, "a", "left").join(b, "b", "left") \
        .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b")
    merged = components(between)
    old = labels.join(merged.select(F.col("v").alias("label"), F.col("label").alias("new")), "label", "left") \
        .select("v", F.coalesce("new", "label").alias("label"))
    fresh = merged.join(labels.select("v"), "v", "left_anti")
    return stored(old.union(fresh), path)

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from opsledger.llm import decontamination, jaccard_join, line_dedup, quality_rules, repeated_bytes
from opsledger.llm.components import components
from opsledger.llm.shingles import shingle_set
from tests.llm.conftest import prose


def test_lines_of_odd_rows(odd, empty):
    out = line_dedup.remove_repeated_lines(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and set(odd.columns) <= set(out.columns)
    by = {r.doc_id: r for r in rows}
    assert by[1].text is None and by[1].n_lines == 0 and by[2].n_lines == 1 and by[2].text == ""
    assert (by[11].n_removed, by[11].n_spans, by[11].text) == (3, 1, "a\nb\nc\nd")
    assert line_dedup.remove_repeated_lines(empty).count() == 0


def test_later_passages_go(spark):
    data = [(2, "x\n1\n2\n3\n4\ny"), (1, "1\n2\n3\n4"), (3, "q\n2\n3\n4\nr\n1\n2\n3"), (3, "q\n2\n3\n4\nr\n1\n2\n3"), (4, "\n\n\n\n\n\n")]
    rows = line_dedup.remove_repeated_lines(spark.createDataFrame(data, "doc_id bigint, text string")).collect()
    found = Counter((r.doc_id, r.text, r.n_removed, r.n_spans) for r in rows)
    assert found == Counter({(2, "x\ny", 4, 1): 1, (1, "1\n2\n3\n4", 0, 0): 1, (3, "q\nr", 6, 2): 2, (4, "\n\n\n\n\n\n", 0, 0): 1})


def test_rules_of_odd_rows(odd, empty):
    rows = quality_rules.apply_rules(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].base_failed and by[1].n_words == 0 and not by[3].kept and by[5].kept and by[5].n_words == 120
    assert quality_rules.apply_rules(empty).count() == 0


def test_rule_order_never_changes_the_verdict(spark, odd):
    rules = quality_rules.production_rules()
    verdicts = [Counter((r.doc_id, r.kept) for r in quality_rules.apply_rules(odd, rules=x).collect()) for x in (rules, rules[::-1])]
    assert verdicts[0] == verdicts[1]


def test_cascade_puts_the_best_rejector_first(spark):
    docs = spark.createDataFrame([(i, "word " * 60) for i in range(200)], "doc_id bigint, text string")
    never = quality_rules.Rule("never", lambda: quality_rules.F.col("n_words") < 0)
    always = quality_rules.Rule("always", lambda: quality_rules.F.col("n_words") > 0)
    assert [r.name for r in quality_rules.cascade_order(docs, [never, always])][0] == "always"


def brute_components(texts, words, percent):
    sets = {k: set(shingle_set(t, words).tolist()) for k, t in texts.items()}
    label = {k: k for k in texts}
    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y) and label[a] != label[b]:
                lo, hi = sorted((label[a], label[b]))
                label = {k: lo if v == hi else v for k, v in label.items()}
    return label


@pytest.mark.parametrize("small, matrix", [(16, 2048), (2, 8)])
def test_components_equal_brute_force(spark, monkeypatch, small, matrix):
    """Near copies around the limit, chains and exact copies; small limits send groups through every way."""
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "MATRIX", matrix)
    rng = random.Random(5)
    texts = {}
    for group in range(4):
        words = prose(rng, rng.choice([12, 60, 150])).split()
        for _ in range(25):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = prose(rng, 1) + str(rng.randrange(99))
            texts[len(texts)] = " ".join(copy)
    for _ in range(30):
        texts[len(texts)] = prose(rng, rng.randint(1, 40))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == brute_components(texts, 4, 85)


def test_shared_signatures_are_found_without_a_window(spark, odd, monkeypatch):
    plans, write = {}, jaccard_join.stored

    def stored(df, path):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, path)

    monkeypatch.setattr(jaccard_join, "stored", stored)
    jaccard_join.jaccard_components(odd).count()
    assert "Window" not in plans["shared"] and "Aggregate" in plans["several"]


def test_components_of_odd_rows(odd, empty):
    rows = jaccard_join.jaccard_components(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_shingles, by[1].component_id, by[3].component_id, by[7].component_id) == (0, 1, 3, 5)
    assert by[4].n_shingles == 1 and by[None].component_id is None
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_signatures_meet_at_the_limit():
    """Random pairs just inside the limit share a signature, whatever their size."""
    rng, bands = np.random.default_rng(2), jaccard_join.Bands(85)
    for size in [7, 8, 9, 12, 20, 33, 50, 100, 400, 1500] * 3:
        common = rng.integers(0, 1 << 64, size, dtype=np.uint64)
        spare = int(size / 0.85) - size
        left = int(rng.integers(0, spare + 1))
        a = np.unique(np.append(common, rng.integers(0, 1 << 64, left, dtype=np.uint64)))
        b = np.unique(np.append(common, rng.integers(0, 1 << 64, spare - left, dtype=np.uint64)))
        if len(np.intersect1d(a, b)) * 100 >= 85 * len(np.union1d(a, b)) and spare:
            assert np.intersect1d(bands.signatures(a), bands.signatures(b)).size, size


@pytest.mark.parametrize("percent", [80, 85])
def test_empty_parts_do_not_gather_unrelated_sets(percent):
    """Sets that are small in their band have many empty parts; one signature of these would group them all."""
    rng, bands = np.random.default_rng(7), jaccard_join.Bands(percent)
    for size in (100, 150, 200, 250, 380, 700, 1000, 1500):
        found = np.concatenate([bands.signatures(rng.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(60)])
        assert np.unique(found, return_counts=True)[1].max() == 1, size


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_signature_wherever_they_differ(percent):
    """Also sets whose other elements lie in few parts, and differences that spoil as many groups as they can."""
    rng, bands = np.random.default_rng(5), jaccard_join.Bands(percent)
    pool = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    for size in [*range(1, 60), 94, 95, 140, 200, 316, 400]:
        for turn in range(6):
            drawn = rng.permutation(pool)
            if turn % 2:  # the sets crowd in few parts of their band
                multiplier = np.uint64((bands.band(size) * 2 + 1) * 0xD1342543DE82EF95 % (1 << 64))
                drawn = drawn[np.argsort((jaccard_join.mixed(drawn + multiplier) >> np.uint64(20)) % np.uint64(12), kind="stable")]
            a = np.unique(drawn[:size])
            for more in range(size * 100 // percent - size + 1):
                less = next(x for x in range(size, -1, -1) if 100 * (size - x) >= percent * (size + more))
                b = np.unique(np.concatenate([a[less:], drawn[size:size + more]]))
                if less or more:
                    assert np.intersect1d(bands.signatures(a), bands.signatures(b)).size, (size, less, more)


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for size in (0, 1, 50, 400, 700, 3000, 20_000):
        a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        b = np.unique(np.append(a[size // 5:], rng.integers(0, 1 << 64, size // 3 + 1, dtype=np.uint64)))
        bound = jaccard_join.least_difference(jaccard_join.parity_sketch(a), jaccard_join.parity_sketch(b))
        assert 0.7 * len(np.setxor1d(a, b)) <= bound + 1 and bound <= len(np.setxor1d(a, b))


def test_long_chain_is_one_component(spark):
    links = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {r.label for r in components(links).collect()} == {0}


def brute_bytes(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        runs = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        out.append((sum(mark), runs, hashlib.sha256(bytes(x for x, m in zip(t, mark) if not m)).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_bytes_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    parts = [prose(rng, n) for n in (20, 70, 80, 150)] + ["ab" * 300, "z" * 500]
    texts = [" ".join(rng.choice([prose(rng, 10), rng.choice(parts), rng.choice(parts)[rng.randrange(30):]]) for _ in range(rng.randint(1, 4)))
             for _ in range(60)] + ["é" * 300, "é" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_bytes.remove_repeated_bytes(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_bytes([t.encode() for t in texts], 400)


def test_repeated_bytes_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "CHUNK", 1000)
    rng = random.Random(5)
    part = prose(rng, 150)
    texts = [prose(rng, rng.randint(300, 900)) for _ in range(12)]
    texts += [f"{prose(rng, rng.randint(40, 300))} {part} {prose(rng, 200)}" for _ in range(8)] + ["z" * 2500, "ab" * 1700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_bytes.remove_repeated_bytes(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_bytes([t.encode() for t in texts], 400)


def test_repeated_bytes_of_odd_rows(odd, empty, monkeypatch):
    rows = repeated_bytes.remove_repeated_bytes(odd).collect()
    given = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    wanted = Counter((k, *x) for (k, _), x in zip(given, brute_bytes([t for _, t in given], 400)))
    assert Counter((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == wanted
    assert repeated_bytes.remove_repeated_bytes(empty).count() == 0


def test_benchmark_recall_and_clean_documents(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randint(15, 59)) + ". " + prose(rng, 5)) for i in range(40)]
    docs, wanted = [], set()
    for d in range(300):
        text = prose(rng, rng.randint(20, 300))
        if d % 3 == 0:
            i = rng.randrange(40)
            words = items[i][1].split()
            if d % 2:  # a paraphrase: a tenth of the words changed, the answer kept
                for _ in range(len(words) // 10):
                    words[rng.randrange(len(words) - 6)] = "other"
            at = rng.randrange(len(text))
            text, _ = text[:at] + " " + " ".join(words) + " " + text[at:], wanted.add((d, i))
        docs.append((d, text))
    found = decontamination.benchmark_matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                              spark.createDataFrame(items, "item_id bigint, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert len(pairs & wanted) >= 0.9 * len(wanted) and not pairs - wanted


def brute_matches(docs, items):
    """Pairs of which four fifths of the item's words stand in order within five quarters of its length."""
    found = set()
    for i, text in items:
        item = text.encode().split()
        for d, other in docs:
            words, reach = other.encode().split(), -(-5 * len(item) // 4)
            hits = [p for p, w in enumerate(words) if w in set(item)]
            if any(5 * decontamination.common_subsequence(item, words[p:p + reach]) >= 4 * len(item) for p in hits):
                found.add((d, i))
    return found


def test_benchmark_of_many_items(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, rng.randint(15, 59))) for i in range(2048)]
    docs = []
    for d in range(120):
        words = items[d * 17][1].split()
        for x in range(d % 3, len(words), 7 if d % 2 else 1000):  # exact copies and copies with a seventh of the words changed
            words[x] = "other"
        docs.append((d, f"{prose(rng, rng.randint(20, 90))} {' '.join(words)} {prose(rng, rng.randint(20, 90))}"))
    wanted = brute_matches(docs, [items[d * 17] for d in range(120)])
    found = decontamination.benchmark_matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                              spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert len(wanted) >= 100 and not wanted - {(r.doc_id, r.item_id) for r in found}


def test_benchmark_of_hot_and_long_passages(spark):
    rng = random.Random(14)
    items = [(1, prose(rng, 18)), (2, prose(rng, 900)), (3, prose(rng, 40))]
    docs = [(d, f"{prose(rng, 60)} {items[0][1] if d % 3 else ''} {prose(rng, 60)}") for d in range(240)]
    docs += [(1000, f"{prose(rng, 100)} {items[1][1]} {prose(rng, 90)}")]
    wanted = {(d, 1) for d in range(240) if d % 3} | {(1000, 2)}
    found = decontamination.benchmark_matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                              spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted


def test_benchmark_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, odd.where("doc_id = 5").first().text[:200])], "item_id bigint, text string")
    rows = decontamination.benchmark_matches(odd, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(k, 3) for k in (5, 6, 7, None)}
    assert decontamination.benchmark_matches(empty, items).count() == 0
    assert decontamination.benchmark_matches(odd, items.limit(0)).count() == 0


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(0, 90))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(a, b) == table[-1][-1]


def test_lines_of_documents_without_a_key(spark):
    """Different texts without a key have places of their own; one of them keeps the passage, copies as a whole stay."""
    passage = "one line\ntwo lines\nthree lines"
    data = [(None, f"{passage}\nx"), (None, f"{passage}\ny"), (None, f"{passage}\ny"), (1, f"z\n{passage}")]
    rows = line_dedup.remove_repeated_lines(spark.createDataFrame(data, "doc_id bigint, text string")).collect()
    kept = {r.text for r in rows if passage in (r.text or "")}
    assert len(kept) == 1 and len(rows) == 4 and not any(r.doc_id == 1 and passage in r.text for r in rows)


@pytest.mark.parametrize("count", [200, 600, 2048])
def test_latent_search_alone_finds_nine_of_ten(spark, count):
    """The candidates of the latent spaces, without any lookup of rare words, against brute force."""
    rng = random.Random(count)
    items = [(i, prose(rng, rng.randint(15, 59))) for i in range(count)]
    docs = []
    for d in range(150):
        words = items[d * (count // 150)][1].split()
        for x in range(d % 3, len(words), 7 if d % 2 else 1000):
            words[x] = "other"
        docs.append((d, f"{prose(rng, rng.randint(20, 90))} {' '.join(words)} {prose(rng, rng.randint(20, 90))}"))
    wanted = brute_matches(docs, [items[d * (count // 150)] for d in range(150)])
    frame, bench = (spark.createDataFrame(rows, f"{name} bigint, text string") for rows, name in ((docs, "doc_id"), (items, "item_id")))
    found = {(r.doc_id, r.item_id) for r in decontamination.benchmark_matches(frame, bench, rare_words=False).collect()}
    assert len(wanted) >= 130 and len(found & wanted) >= 0.9 * len(wanted)


def test_the_latent_space_counts_every_document(spark, monkeypatch):
    """Each of more documents than a sample of 2000 holds leaves its trace in what the latent space is fitted on."""
    rng = random.Random(21)
    rows = [(d, f"once{d} {prose(rng, rng.randint(0, 60))}") for d in range(2600)] + [(None, "once2600"), (1, None), (2601, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    fitted = []
    real = decontamination.LatentIndex.fit
    monkeypatch.setattr(decontamination.LatentIndex, "fit", lambda self, sketch, rank: (fitted.append((self, sketch)), real(self, sketch, rank))[1])
    item = " ".join(f"once{d}" for d in range(0, 2601, 13))
    decontamination.benchmark_matches(frame, spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    (index, sketch), = fitted
    single = Counter(b for _, t in rows for b in set(decontamination.buckets_of((t or "").encode().split()).tolist()))
    single = [i for i, b in enumerate(index.used.tolist()) if single[b] == 1]
    assert len(single) > 150 and all(np.count_nonzero(sketch[:, i]) == 1 for i in single)


def test_counts_of_a_corpus_equal_a_plain_loop(spark, odd, empty):
    rng = random.Random(22)
    rows = [(d, prose(rng, rng.randint(0, 90))) for d in range(90)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").union(odd.select("doc_id", "text"))
    texts = [[x.lower() for x in (r.text or "").encode().split()] for r in frame.collect()]
    used = np.unique(decontamination.buckets_of([w for t in texts[:40] for w in t]))
    made = [decontamination.corpus_counts(frame.repartition(n), used) for n in (1, 7)]
    documents, passages = Counter(), Counter()
    for words in texts:
        ids = decontamination.buckets_of(words).tolist()
        documents.update(set(ids))
        passages.update(b for at in range(0, len(ids), decontamination.BLOCK) for b in set(ids[at:at + decontamination.BLOCK]))
    for x in made:
        assert x.n_docs == len(texts) and {b: n for b, n in enumerate(x.frequencies.tolist()) if n} == documents
        # each block with the word moves one number by one
        size = np.abs(x.sums).sum(axis=1).tolist()
        assert all(s <= passages[b] and (passages[b] - s) % 2 == 0 for b, s in zip(used.tolist(), size))
    assert (made[0].sums == made[1].sums).all() and (made[0].used == used).all()
    none = decontamination.corpus_counts(empty, used)
    assert none.n_docs == 0 and not none.frequencies.any() and not none.sums.any()
    assert not made[0].sketch(np.array([decontamination.BUCKETS - 1]), np.ones(decontamination.BUCKETS + 1)).any() or decontamination.BUCKETS - 1 in used

"""Suffix, window and near-duplicate removal and decontamination against brute force."""

from __future__ import annotations

import itertools
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from clipward.llm import decontaminate, frames, graphs, hashing, suffix_dedup, units, weighted_minhash, window_dedup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int, n: int = 60) -> list[str | None]:
    """Copies, shared passages, periodic runs, short and empty texts, non-ASCII, odd white space."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdeéßñ") for _ in range(draw.randint(2, 9))) for _ in range(400)]
    text = lambda k: "".join(draw.choice(vocabulary) + draw.choice([" ", " ", "\n", "\t ", "\x0b"]) for _ in range(k))
    passages = [text(draw.randint(20, 150)) for _ in range(5)]
    out: list[str | None] = [None, "", "one", " \n ", "For " * 300, "For " * 301, "x" * 1500]
    while len(out) < n:
        kind = draw.random()
        if kind < 0.3:
            out.append(text(draw.randint(1, 250)))
        elif kind < 0.5:
            out.append(text(draw.randint(5, 60)) + draw.choice(passages) + text(draw.randint(5, 60)))
        elif kind < 0.7:
            out.append(draw.choice(out[7:] or [text(80)]))
        else:
            words = (draw.choice(out[7:] or [text(80)]) or "").split(" ")
            for _ in range(draw.randint(1, 3)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            out.append(" ".join(words))
    return out


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "old", 7) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_removed string, unit int")


# ---------------------------------------------------------------- helpers


def test_integers_pack():
    for values in ([], [5], [0, 2**64 - 1], [3, 3, 900, 2**40]):
        packed = np.array(values, np.uint64)
        assert units.unpack_ints(units.pack_ints(packed, True)).tolist() == values
    signed = np.array([-5, 2**62, 0, -(2**63)], np.int64)
    assert (units.unpack_ints(units.pack_ints(signed)).view(np.int64) == signed).all()


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    monkeypatch.setattr(hashing, "SLICE", 16)
    data = np.frombuffer(b"  alpha beta alpha " + b"q" * 50 + b"\x0balpha", np.uint8)
    lo, hi, keys = hashing.words(data)
    said = [bytes(data[a:b]) for a, b in zip(lo, hi)]
    assert said == [b"alpha", b"beta", b"alpha", b"q" * 50, b"alpha"]
    assert len({k for k, s in zip(keys.tolist(), said) if s == b"alpha"}) == 1
    assert len(set(keys.tolist())) == 3


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_bounded_prefixes(letters):
    draw = np.random.default_rng(letters)
    text = np.append(draw.integers(0, letters, 200), letters)
    order, common = suffix_dedup.bounded_prefixes(text, 9)
    tails = [tuple(text[i : i + 9]) for i in order]
    assert tails == sorted(tails)
    for i in range(1, len(order)):
        same = 0
        for a, b in zip(tails[i - 1], tails[i]):
            if a != b:
                break
            same += 1
        assert common[i] == same


# ---------------------------------------------------------------- suffixes


@pytest.mark.parametrize("hot", [1024, 1])
def test_suffix_dedup(spark, hot):
    texts = corpus(4)
    seen = Counter()
    for t in texts:
        body = (t or "").encode()
        seen.update(body[k : k + 400] for k in range(len(body) - 399))
    rows = suffix_dedup.remove_repeats(frame(spark, texts), hot=hot).collect()
    assert len(rows) == len(texts) and rows[0].unit == 7
    for row in rows:
        body = (texts[row.doc_id] or "").encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 399):
            if seen[body[k : k + 400]] > 1:
                gone[k : k + 400] = True
        assert row.n_bytes == len(body) and row.n_removed == gone.sum()
        assert row.n_spans == (np.diff(gone.astype(int), prepend=0) == 1).sum()
        assert bytes(row.kept) == bytes(b for b, g in zip(body, gone) if not g)
        assert (row.text is None) == (texts[row.doc_id] is None)


def test_suffix_dedup_cuts_long_texts_into_slices(spark, monkeypatch):
    draw = random.Random(1)
    long = "".join(draw.choice("abcdef ") for _ in range(6000))
    whole = suffix_dedup._Contexts(*_rows([long, long[1000:3000]]))
    monkeypatch.setattr(suffix_dedup, "SLICE", 700)
    cut = suffix_dedup._Contexts(*_rows([long, long[1000:3000]]))
    assert (whole.at == cut.at).all() and (whole.pair == cut.pair).all()


def _rows(texts):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text"


def test_weight_bound_never_refuses_a_pair_at_the_threshold(monkeypatch):
    monkeypatch.setattr(weighted_minhash, "MANY_CLASSES", 1024)
    rng = np.random.default_rng(9)
    docs = []
    for size in (1, 3, 40, 180, 200, 220, 900, 1000, 1050, 1100, 3000):  # all kinds of profiles, and pairs of two kinds
        base, weight = rng.integers(0, 1 << 63, size).astype(np.uint64), rng.uniform(1, 3, size)
        for share in (1.0, 0.95, 0.9, 0.85, 0.8, 0.5, 0.1):
            n = int(size * share)
            keys = np.concatenate([base[:n], rng.integers(0, 1 << 63, size - n).astype(np.uint64)])
            order = np.argsort(keys)
            docs.append((keys[order], weight[order]))
    first = np.cumsum([0, *(len(k) for k, _ in docs)])
    held = weighted_minhash._Vectors(
        np.repeat(np.arange(len(docs)), np.diff(first)), np.concatenate([k for k, _ in docs]), np.ones(first[-1]), len(docs)
    )
    made = weighted_minhash.profiles(held, np.concatenate([w for _, w in docs]))
    total = np.array([w.sum() for _, w in docs])
    x, y = (c.ravel() for c in np.triu_indices(len(docs), 1))
    open_ = weighted_minhash.may_reach(made, total, x, y)
    alike = np.array([weighted_minhash.weighted_jaccard(docs[i], docs[j]) for i, j in zip(x, y)])
    assert (alike >= 0.8).sum() > 5 and open_[alike >= 0.8].all()
    assert open_[alike < 0.4].mean() < 0.1


def test_anchor_keys_spread_over_buckets():
    rng = random.Random(8)
    text = "".join(chr(rng.randint(97, 122)) for _ in range(200_000))
    held = suffix_dedup._Contexts(*_rows([text]))
    counts = np.bincount((held.key >> np.uint64(58)).astype(np.int64), minlength=64)
    assert len(held.key) > 1000 and counts.max() < 4 * counts.mean()
    again = suffix_dedup._Contexts(*_rows([text]), held.pack())
    for name in ("at", "key", "context", "pair", "lo", "hi"):
        assert np.array_equal(getattr(again, name), getattr(held, name))


# ---------------------------------------------------------------- windows


def windows_brute(texts, ids):
    order = lambda i: (i is None, i or 0)
    least: dict = {}
    split = [WORDS.findall(t or "") for t in texts]
    for words, i in zip(split, ids):
        for k in range(len(words) - 12):
            key = tuple(words[k : k + 13])
            least[key] = min(least.get(key, order(i)), order(i))
    out = []
    for words, i in zip(split, ids):
        gone = set()
        for k in range(len(words) - 12):
            if least[tuple(words[k : k + 13])] < order(i):
                gone.update(range(k, k + 13))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


@pytest.mark.parametrize("odd_ids", [False, True])
def test_window_dedup(spark, odd_ids):
    texts = corpus(9)
    ids = list(range(len(texts)))
    if odd_ids:  # null, equal and negative ids
        ids = [None if i % 11 == 0 else (i % 20) - 5 for i in ids]
    want = windows_brute(texts, ids)
    rows = window_dedup.remove_repeats(frame(spark, texts, ids), single_spaces=True).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.text or "") for r in rows]
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = window_dedup.remove_repeats(frame(spark, texts, ids)).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, " ".join(WORDS.findall(r.text or ""))) for r in kept]
    assert sorted(got, key=key) == sorted(want, key=key)
    unchanged = {t for t in texts if t}
    assert all(r.text in unchanged for r in kept if r.n_removed == 0 and r.text)


def test_difference_cover():
    for a in range(window_dedup.PERIOD):
        for b in range(window_dedup.PERIOD):
            assert any(
                {(a + d) % window_dedup.PERIOD, (b + d) % window_dedup.PERIOD} <= set(window_dedup.COVER)
                for d in range(window_dedup.PERIOD)
            )


# ---------------------------------------------------------------- near duplicates


def weights(texts):
    bags = {}
    for i, t in enumerate(texts):
        words = WORDS.findall(t or "")
        k = min(5, len(words))
        if k:
            bags[i] = Counter(tuple(words[j : j + k]) for j in range(len(words) - k + 1))
    df = Counter(s for bag in bags.values() for s in bag)
    n = len(texts)
    return {i: {s: c * (1 + math.log((1 + n) / (1 + df[s])) / math.log(1 + n)) for s, c in bag.items()} for i, bag in bags.items()}


def similarity(a, b):
    low = sum(min(w, b[s]) for s, w in a.items() if s in b)
    return low / (sum(a.values()) + sum(b.values()) - low)


def test_near_classes(spark):
    texts = corpus(21, 80)
    bags = weights(texts)
    root = list(range(len(texts)))
    for i in bags:
        for j in bags:
            if j < i and similarity(bags[i], bags[j]) >= 0.8:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    got = {r.doc_id: r.class_id for r in weighted_minhash.classes(frame(spark, texts)).collect()}
    assert got == dict(enumerate(root))
    assert len(set(root)) < len(root)
    kept = weighted_minhash.keep_one(frame(spark, texts)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root))
    assert all(r.text == texts[r.doc_id] for r in kept)


def test_samples_agree_with_weighted_similarity():
    draw = np.random.default_rng(3)
    key = np.sort(draw.integers(0, 2**63, 400)).astype(np.uint64)
    a, b = draw.uniform(0.5, 3, 400), draw.uniform(0.5, 3, 400)
    first = np.array([0, 400])
    same = weighted_minhash.samples(key, a, first, 600) == weighted_minhash.samples(key, b, first, 600)
    assert abs(same.mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.07


def test_shingles_and_samples_of_a_unit_are_those_of_its_texts_in_bounded_memory(monkeypatch):
    rng = random.Random(23)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice((0, 1, 4, 5, 60)))) for _ in range(300)]
    texts[7:9] = [None, " "]
    held = weighted_minhash._shingles(*_rows(texts), 3)
    first, weight = held.first(), held.count * 1.25
    monkeypatch.setattr(weighted_minhash, "SAMPLED", 100, raising=False)
    drawn = weighted_minhash.samples(held.key, weight, first, 6)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        one = weighted_minhash._shingles(*_rows([texts[i]]), 3)
        assert held.key[a:b].tolist() == one.key.tolist() == sorted(set(one.key.tolist()))
        assert held.count[a:b].tolist() == one.count.tolist()
        n_words = len((texts[i] or "").split())
        assert one.count.sum() == (max(n_words - 4, 1) if n_words else 0)
        alone = weighted_minhash.samples(one.key, one.count * 1.25, one.first(), 6)
        assert drawn[i].tolist() == alone[0].tolist()
    monkeypatch.undo()
    # A unit of many texts: what sampling holds does not grow with the unit.
    n = 1 << 19
    key, weight, first = hashing.mix(np.arange(n, dtype=np.uint64)), np.ones(n), np.arange(0, n + 1, 512)
    tracemalloc.start()
    weighted_minhash.samples(key, weight, first, 2)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 16 * n


def test_large_groups_make_few_pairs():
    draw = np.random.default_rng(1)
    marks = np.tile(draw.integers(0, 2**16, 30).astype(np.uint16), (1000, 1))
    marks[:, :3] = draw.integers(0, 2**16, (1000, 3))
    pairs, leads = weighted_minhash.nearest(np.arange(1000), marks, np.ones(1000))
    assert len(leads) < 10 and 990 <= len(pairs) <= 2000


def test_pairs_inside_a_group_of_look_alikes(spark):
    draw = random.Random(11)
    say = lambda n: [f"{draw.randrange(16**6):06x}" for _ in range(n)]
    base, texts, want = say(244), [], {}
    for i in range(160):
        own, other = say(12), say(12)
        shared = say(8)
        texts += [base + shared + own, base + shared + other]
        want |= {2 * i: 2 * i, 2 * i + 1: 2 * i}
    order = list(range(0, 320, 2)) + list(range(1, 320, 2))  # partners are far apart
    rows = spark.createDataFrame([(i, " ".join(texts[i])) for i in order], "doc_id long, text string")
    bags = weights([" ".join(t) for t in texts])
    assert similarity(bags[0], bags[1]) > 0.83 and 0.7 < similarity(bags[0], bags[2]) < 0.78
    got = {r.doc_id: r.class_id for r in weighted_minhash.classes(rows.repartition(3, "doc_id")).collect()}
    assert got == want


def test_second_round_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "CELL", 7)
    monkeypatch.setattr(weighted_minhash, "VECTORS", 5)
    test_near_classes(spark)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.root for r in graphs.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_component_rounds_end_at_stars_and_write_few_files(spark, monkeypatch):
    """Stars need no round; a round of few links writes no more files than there are cores."""
    written = []

    def stored(df, label):
        written.append(frames.stored(df, label))
        return written[-1]

    monkeypatch.setattr(graphs, "stored", stored)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stars = [(i, i - i % 7) for i in range(700)]
        got = {r.node: r.root for r in graphs.components(spark.createDataFrame(stars, "a long, b long")).collect()}
        assert got == {i: i - i % 7 for i in range(700)} and len(written) == 1
        chains = [(i, i + 1) for i in range(700) if i % 7 < 6]
        got = {r.node: r.root for r in graphs.components(spark.createDataFrame(chains, "a long, b long")).collect()}
        assert got == {i: i - i % 7 for i in range(700)}
        assert len(written) > 2 and all(len(df.inputFiles()) <= 8 for df in written[2:])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# ---------------------------------------------------------------- decontamination


def smith_waterman(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment_is_smith_waterman():
    draw = np.random.default_rng(8)
    items = [draw.integers(1, 6, draw.integers(1, 12)).astype(np.uint64) for _ in range(50)]
    texts = [draw.integers(1, 6, draw.integers(1, 30)).astype(np.uint64) for _ in range(50)]
    points, _ = decontaminate.align(items, texts)
    assert points.tolist() == [smith_waterman(a.tolist(), b.tolist()) for a, b in zip(items, texts)]


def test_copies_are_found_and_others_are_not(spark):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8)))
    say = lambda n: [word() for _ in range(n)]
    items = [say(30) for _ in range(6)] + [say(2)]
    edited = list(items[1])
    edited[5], edited[15] = "changed", "also"
    edited.insert(22, "new")
    texts = [
        " ".join(say(80) + items[0] + say(50)),
        " ".join(say(300)),
        " ".join(say(10) + edited + say(400)).upper(),
        None,
        "",
        " ".join(say(50) + items[6] + say(5)),
        " ".join(items[2] + say(3000) + items[2]),
        " ".join(items[2] + say(3000) + items[2]),
        " ".join(say(20) + items[3][:6] + say(20)),
    ]
    bench = [(i, " ".join(t), 0) for i, t in enumerate(items)] + [(90, None, 0), (91, "", 0)]
    tests = spark.createDataFrame(bench, "item_id long, text string, n int")
    got = decontaminate.find_copies(frame(spark, texts), tests).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 0), (2, 1), (5, 6), (6, 2), (7, 2)}
    assert len(got) == 5
    by = {r.doc_id: r for r in got}
    assert by[0].score == 1.0 and by[0].word_end == 110 and 0.7 < by[2].score < 1
    assert by[6].word_end == 30
    assert decontaminate.find_copies(frame(spark, texts).where("false"), tests).count() == 0
    assert decontaminate.find_copies(frame(spark, texts), tests.where("false")).count() == 0


def test_every_accepted_copy_is_found(spark):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(9))
    say = lambda n: [word() for _ in range(n)]
    items = [say(28), say(12), say(4), say(5)]
    fourth = [word() if i % 4 == 3 else w for i, w in enumerate(items[0])]
    spread = [x for w in items[1] for x in (w, word())]
    third = [word() if i % 3 == 2 else w for i, w in enumerate(items[0])]
    texts = [say(20) + fourth + say(9), say(7) + spread + say(30), third + say(3)]
    texts += [say(3) + items[2] + say(3) for _ in range(200)] + [items[3] + say(2), items[3][:4] + say(9)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    want = set()
    for d, t in enumerate(texts):
        for i, w in enumerate(items):
            points = smith_waterman(w, t)
            if points >= max(len(w), min(12, 2 * len(w))):
                want.add((d, i, points))
    got = decontaminate.find_copies(frame(spark, [" ".join(t) for t in texts]), bench).collect()
    assert {(r.doc_id, r.item_id, r.points) for r in got} == want
    assert {(0, 0), (1, 1), (3, 2), (202, 2), (203, 3)} <= {w[:2] for w in want} and len(want) >= 204


def test_frequent_pairs_and_a_text_of_a_million_words(spark):
    """Ordinary phrases in every item, and one long text of them, give the copies that Smith-Waterman accepts."""
    draw = random.Random(3)
    common = [f"p{a} n{b}" for a, b in itertools.product(range(30), repeat=2)]
    rare = lambda: "".join(draw.choice("abcdefgh") for _ in range(8))
    items = [" ".join(draw.choices(common, k=5) + [rare(), rare()] + draw.choices(common, k=3)) for _ in range(300)]
    long = draw.choices(common, k=500_000)
    long[100_000] = items[7]
    long[400_000] = items[8].rsplit(" ", 3)[0]
    short = " ".join(draw.choices(common, k=60) + [items[3].replace("p1", "q")]).split()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.find_copies(frame(spark, [" ".join(long), " ".join(short)]), bench).collect()
    found = {(r.doc_id, r.item_id): r.points for r in got}
    assert found[0, 7] == 36 and found[0, 8] >= 30
    want = {}
    for i, t in enumerate(items):
        points = smith_waterman(t.split(), short)
        if points >= len(t.split()):
            want[1, i] = points
    assert {k: v for k, v in found.items() if k[0] == 1} == want and want


def test_rarest_seeds_are_those_no_accepted_copy_can_miss():
    items = decontaminate.read_items([(0, "a b c d e f g h i j k l m n o p"), (1, "x y"), (2, "")], 2)
    counts = np.arange(len(items.seeds))[::-1]
    chosen = decontaminate.rarest(items, counts)
    n, needed = (items.item == 0).sum(), items.needed[0]
    assert needed > 1 and (chosen.item == 0).sum() == n - needed + 1 and (chosen.item == 1).sum() == 1
    left = set(items.place[items.item == 0]) - set(chosen.place[chosen.item == 0])
    assert len(left) == needed - 1 and (np.diff(chosen.seeds.astype(object)) >= 0).all()


# ---------------------------------------------------------------- empty tables


def test_empty_tables(spark):
    empty = frame(spark, ["x"]).where("false")
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert window_dedup.remove_repeats(empty).count() == 0
    assert weighted_minhash.classes(empty).count() == 0
    assert weighted_minhash.keep_one(empty).count() == 0


def test_null_and_equal_ids_in_classes(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = weighted_minhash.classes(frame(spark, [text, text, text, "other words here"], [None, 5, 5, None]))
    assert sorted(map(str, map(tuple, rows.collect()))) == ["(5, 5)", "(5, 5)", "(None, 5)", "(None, None)"]
    kept = weighted_minhash.keep_one(frame(spark, [text, text, text], [None, 5, 5]))
    assert [r.doc_id for r in kept.collect()] == [5]

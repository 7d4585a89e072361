"""Personal data, fill-in-the-middle and periodic runs against brute-force versions and edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from clipward.llm import fill_in_middle, hashing, periodic_runs, personal_data, queries
from clipward.llm.wavelet import WaveletMatrix

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += sum(divmod(2 * d, 10)) if i % 2 else d
    return total % 10 == 0


def plain_spans(text):
    """The patterns as they are written."""
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]
            if fits():
                found.append((kind, *m.span()))
    return found


def test_detectors_equal_the_patterns():
    rng = random.Random(1)
    pieces = ["a", "B", "7", "42", "255", "256", ".", "..", "-", "+", "%", "_", "@", " ", "(", ")", "\n", "é", "1.2.3.4",
              "x@y.z", "4111111111111111", "4111 1111 1111 1111", "+1 (017) 555-7713", "+4930123456", "０"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 25)))
        assert personal_data.detect(text) == plain_spans(text), text
        assert {s[:3] for s in personal_data.spans(text) if s[3]} == set(plain_spans(text))


def test_detectors_take_linear_time():
    for unit in ("1", "a", "a@", "1.", "+1", "+1(", "1 ", "one ", "dot ", " at ", "a dot ", "plus one ", "ａ", "[", "a.", "@a "):
        began = time.perf_counter()
        personal_data.spans(unit * (200_000 // len(unit)))
        assert time.perf_counter() - began < 5, unit


@pytest.mark.parametrize(
    "text, kind, said",
    [
        ("mail jane (at) example (dot) org now", "email", "jane (at) example (dot) org"),
        ("mail jane.doe [at] example.org now", "email", "jane.doe [at] example.org"),
        ("mail jane dot doe at mail dot example dot org", "email", "jane dot doe at mail dot example dot org"),
        ("mail jаne@exаmple.org now", "email", "jаne@exаmple.org"),  # two Cyrillic letters
        ("mail ja​ne@example.org", "email", "ja​ne@example.org"),
        ("host １９２.１６８.0.1 up", "ip", "１９２.１６８.0.1"),
        ("host ten point? one nine two dot one six eight dot zero dot one.", "ip", "one nine two dot one six eight dot zero dot one"),
        ("call plus four nine three zero, double seven one two three four five!", "phone", "plus four nine three zero, double seven one two three four five"),
        ("ruf plus vier neun drei null sieben sieben eins zwei drei vier fünf an", "phone", "plus vier neun drei null sieben sieben eins zwei drei vier fünf"),
        ("card 4111 one one one one 1111 1111", "card", "4111 one one one one 1111 1111"),
        ("card ４１１１ 1111 1111 1111.", "card", "４１１１ 1111 1111 1111"),
        ("card ٤١١١١١١١١١١١١١١١", "card", "٤١١١١١١١١١١١١١١١"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, said):
    found = [text[a:b] for k, a, b, plain in personal_data.spans(text) if k == kind and not plain]
    assert found == [said]


def test_ordinary_prose_holds_nothing():
    for text in (
        "Look at example.com. One, two, three and four dots. Meet at noon.",
        "plus one five, minus 12 345, 3.14159, version 1.2.3 (at) home",
        "card one 4845168114407328 more; 20 nine 1234567890123",
        "ﬁne café naïve ½ x² №5",
    ):
        assert personal_data.spans(text) == [], text


def test_number_words_beside_numbers_are_no_part_of_them():
    for text in ("un 79.86.197.198 two", "one 4111 1111 1111 1111 nine", "five five +1 (017) 555-7713 two, six"):
        assert all(plain for *_, plain in personal_data.spans(text)), text
        assert len(personal_data.spans(text)) == 1


def test_a_longer_address_holds_the_plain_part():
    text = "jоhn@example.com"  # the second letter is Cyrillic
    assert personal_data.spans(text) == [("email", 0, 16, False), ("email", 2, 16, True)]
    assert personal_data.masked(text, personal_data.spans(text)) == "<email>"


def test_personal_data_rows(spark):
    texts = [None, "", "a@b.c and a@b.c", "a@b.c and a@b.c", "ip 1.2.3.4 " * 20000, "é +1 (017) 555-7713"]
    rows = [(i if i else None, t, "old", "old") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, kind string")
    found = personal_data.find(docs, mask="safe")
    assert found.columns == ["doc_id", "text", "kind", "spans", "safe"]
    got = {r.doc_id: r for r in found.collect()}
    assert got[None].spans == [] and got[None].safe is None and got[1].safe == ""
    assert [tuple(s) for s in got[2].spans] == [("email", 0, 5, True), ("email", 10, 15, True)] == [tuple(s) for s in got[3].spans]
    assert len(got[4].spans) == 20000 and got[4].spans[-1].end == len(texts[4]) - 1
    assert got[5].safe == "é <phone>"
    assert personal_data.find(docs.limit(0)).count() == 0


def test_personal_data_query(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.QUERIES["op11_personal_data"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    kinds = list(BASE)
    for doc in docs:
        base = sorted(plain_spans(doc.text or ""), key=lambda s: (s[1], kinds.index(s[0])))
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = rows[doc.doc_id]
        assert row.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.n_email >= sum(k == "email" for k, _, _ in base)
        if row.n_disguised == 0:
            assert row.spans == said


# ---------------------------------------------------------------- fill in the middle


def test_ranks_equal_counts():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 511, 512, 513, 4096, 5000):
        codes = rng.integers(0, 8, n).astype(np.uint8)
        matrix = WaveletMatrix(codes, 3)
        for i in {0, n, *rng.integers(0, n + 1, 20).tolist()}:
            for c in range(8):
                assert matrix.rank(c, i) == int((codes[:i] == c).sum())
        for some in ((0,), (1, 5), (0, 2, 7)):
            hits = np.flatnonzero(np.isin(codes, some))
            for k in {0, 1, len(hits) // 2, len(hits)} - {0} & set(range(len(hits) + 1)):
                assert matrix.after(some, k) == hits[k - 1] + 1
            assert matrix.after(some, 0) == 0 and matrix.after(some, len(hits) + 1) == n


SPLITS = {
    "line": r"[^\n]*\n|[^\n]+",
    "word": r"\s*\S+|\s+$",
    "char": r"(?s).",
    "sentence": r"(?s).*?(?:[.!?…](?=\s|$)|\n)|.+$",
}


def test_places_equal_split_units():
    table = fill_in_middle._class_table()
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices(["a", "é", "😀", " ", "\n", ". ", "!", "\t", "<P", "x y"], k=rng.randint(0, 40)))
        for unit, pattern in SPLITS.items():
            parts = [p for p in re.findall(pattern, text) if p]
            assert "".join(parts) == text
            bounds = fill_in_middle.Boundaries(text, unit, table)
            assert bounds.n == len(parts), (text, unit)
            for k in range(len(parts) + 1):
                assert bounds.place(k) == len("".join(parts[:k]))


TEXTS = [None, "", "one\ntwo\nthree", "one\ntwo\nthree", "\n", "\n\n\n", "no end", "a<S>b\nc", "a<\nP>S>\n<M", "é😀\n" * 50000, "x" * 300000, "<\n<\n<S\n"]


def test_rearranged_texts_are_rebuilt(spark):
    rows = [(None if i == 11 else i, t, "old", "old") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n string")
    made = fill_in_middle.transform(docs)
    assert made.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    got = {r.doc_id: r for r in made.collect()}
    for key, text, *_ in rows:
        text, row = text or "", got[key]
        units = re.findall(SPLITS["line"], text)
        digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
        h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
        a, b = sorted(x % (len(units) + 1) for x in h[:2])
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        plain = not text or any(s in text for s in ("<P>", "<S>", "<M>"))
        expected = "plain" if plain else "spm" if h[3] % 100 < 50 else "psm"
        output = {"plain": text, "psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[expected]
        assert (row.n, row.form, row.output, row.restored) == (len(units), expected, output, text)
        assert (row.prefix_chars, row.middle_chars) == ((None, None) if plain else (len(prefix), len(middle)))
    assert fill_in_middle.transform(docs.limit(0)).count() == 0
    kept = fill_in_middle.transform(docs, rate=0).collect()
    assert {r.form for r in kept} == {"plain"} and all(r.output == (r.text or "") for r in kept)
    words = fill_in_middle.transform(docs, unit="word", spm_rate=0).collect()
    assert all(r.restored == (r.text or "") for r in words) and "spm" not in {r.form for r in words}


# ---------------------------------------------------------------- periodic runs


def brute_runs(words):
    """Every maximal stretch of every period, kept with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(24, 3 * q):
                stretch = words[i : i + length]
                if not any(all(stretch[k] == stretch[k + r] for k in range(length - r)) for r in range(1, q)):
                    found[i, q] = length
            i = j
    return sorted((s, length, q) for (s, q), length in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def random_words(rng):
    kind = rng.randrange(5)
    alphabet = [chr(97 + i) for i in range(rng.choice([1, 2, 3, 30]))]
    block = lambda n: rng.choices(alphabet, k=n)
    if kind == 0:
        return block(rng.randint(0, 120))
    if kind == 1:
        return block(rng.randint(0, 9)) + block(rng.randint(1, 50)) * rng.randint(1, 6) + block(rng.randint(0, 9))
    if kind == 2:  # periods whose seeds also recur inside the period
        inner = block(rng.randint(1, 6)) * rng.randint(2, 8)
        return (inner + block(rng.randint(0, 4))) * rng.randint(2, 5)
    if kind == 3:
        w = block(20)
        return (w + w + block(1) + w) * 4
    a, b = block(rng.randint(1, 40)), block(rng.randint(1, 40))
    return a * rng.randint(1, 9) + b * rng.randint(1, 9) + a * rng.randint(1, 9)


def test_runs_equal_brute_force():
    rng = random.Random(4)
    documents = [random_words(rng) for _ in range(400)]
    documents += [["a"] * 23, ["a"] * 24, list("ab") * 12, list("abcdefghi") * 3, (list("abcdefgh") * 3)[:23]]
    for at in range(0, len(documents), 45):
        part = documents[at : at + 45]
        data, starts = hashing.joined([" ".join(w).encode() for w in part])
        lo, _, words = hashing.words(data)
        counts = np.bincount(np.searchsorted(starts, lo, side="right") - 1, minlength=len(part))
        begins = np.cumsum(counts) - counts
        got = [[] for _ in part]
        for s, length, q in zip(*(c.tolist() for c in periodic_runs.runs(words, begins))):
            i = int(np.searchsorted(begins, s, side="right")) - 1
            got[i].append((s - int(begins[i]), length, q))
        assert got == [brute_runs(w) for w in part]


def test_long_repeats_take_little_time():
    for words in (["a"] * 300_000, list("ab" * 150_000), [f"w{i % 1000}" for i in range(300_000)]):
        began = time.perf_counter()
        hashes = hashing.words(hashing.joined([" ".join(words).encode()])[0])[2]
        start, length, _ = periodic_runs.runs(hashes, np.zeros(1, np.int64))
        assert start.tolist() == [0] and length.tolist() == [300_000]
        assert time.perf_counter() - began < 20


def test_collapse_rows(spark):
    texts = [None, "", " \t ", "no  run\nhere", "x " + "ab cd " * 12 + "y", "x " + "ab cd " * 12 + "y", "é é " * 24]
    rows = [(i if i else None, t, "old", "old") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words string")
    found = periodic_runs.collapse(docs)
    assert found.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = {r.doc_id: r for r in found.collect()}
    assert all(got[k].runs == [] and got[k].collapsed == "" for k in (None, 1, 2))
    assert got[3].collapsed == "no run here"
    assert [tuple(r) for r in got[4].runs] == [(1, 24, 2)] and got[4].collapsed == "x ab cd y" == got[5].collapsed
    assert got[6].n_words == 24 and got[6].collapsed == "é é"
    assert periodic_runs.collapse(docs.limit(0)).count() == 0


def test_periodic_query_equals_brute_force(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    seen = 0
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc.text or "")
        h = zlib.crc32(str(doc.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        elif n > 1200:
            continue  # the brute force is cubic; planted ones are all compared
        runs = brute_runs(words) if n <= 3000 else None
        row = rows[doc.doc_id]
        if runs is None:
            continue
        seen += bool(runs)
        said = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert row.runs_sha256 == hashlib.sha256(said.encode()).hexdigest(), doc.doc_id
        left = " ".join(brute_collapsed(words, runs))
        assert row.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    assert seen > 5

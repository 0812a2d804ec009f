"""Numpy and plain helpers against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.bytewords import shingles_of, text_slices, words_of
from tidemark.llm.eliasfano import EliasFano
from tidemark.llm.htmltext import classes_of, extract, nesting, template_of
from tidemark.llm.lm import PairTrie
from tidemark.llm.pii import fit_label_model
from tidemark.llm.suffixes import suffix_array
from tidemark.llm.tokencount import PieceAutomaton


def words(text):
    lower = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]


@pytest.mark.parametrize("k", [1, 3, 5])
def test_shingles(k):
    rng = random.Random(k)
    texts = ["".join(rng.choice("aAbB é\n\t") for _ in range(rng.randint(0, 14))) for _ in range(800)] + [None, ""]
    seen, back = {}, {}
    for row, data, offsets in text_slices(pa.array(texts), 200):
        found = shingles_of(words_of(data, offsets), k)
        for i in range(len(offsets) - 1):
            w = words(texts[row + i])
            expected = [tuple(w[j : j + k]) for j in range(len(w) - k + 1)] or ([tuple(w)] if w else [])
            hashes = found.hash[found.doc == i].tolist()
            assert len(hashes) == len(expected)
            for a, b in zip(expected, hashes):
                assert seen.setdefault(a, b) == b and back.setdefault(b, a) == a


def test_suffix_array():
    rng = random.Random(2)
    for _ in range(500):
        text = bytes(rng.choice(b"abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 30)))
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("top", [1, 50, 1 << 20, 1 << 40, (1 << 64) - 1])
def test_elias_fano(top):
    rng = np.random.default_rng(0)
    values = np.sort(rng.integers(0, top, 3000, dtype=np.uint64))
    coded = EliasFano(EliasFano.encode(values))
    assert (coded.decode() == values).all()
    asked = np.r_[values[::7], rng.integers(0, top, 200, dtype=np.uint64)]
    n = np.full(len(asked), len(values))
    assert (coded.search(np.zeros(len(asked)), n, asked) == np.searchsorted(values, asked)).all()
    assert EliasFano(EliasFano.encode(np.zeros(0, np.uint64))).decode().tolist() == []


def test_pair_trie():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64) >> np.uint64(20) << np.uint64(5))
    counts = rng.integers(1, 1000, len(keys))
    trie = PairTrie(PairTrie.build(keys, counts))
    found = trie.find(np.r_[keys, keys + np.uint64(1)])
    assert np.allclose(2 ** ((found[: len(keys)] - 1.0) / 2048), counts, rtol=3e-4)
    assert (found[len(keys) :] == 0).all()


def test_automaton():
    rng = random.Random(3)
    some = lambda: {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 9))}
    for _ in range(100):
        starts, rest = some(), some()
        automaton = PieceAutomaton(starts | rest, rest)
        for _ in range(40):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
            n = at = 0
            while at < len(word):
                pieces = starts | rest if at == 0 else rest
                at, before = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), 0), at
                if not at:
                    n = -1
                    break
                n += 1
            assert automaton.count(word) == n


def test_label_model_trusts_agreeing_labelers():
    p = fit_label_model({("card", (1, 1, -1)): 80.0, ("card", (0, -1, -1)): 100.0, ("card", (1, -1, 1)): 20.0})
    assert p["card", (1, 1, -1)] > 0.9 > 0.2 > p["card", (0, -1, -1)]


def test_extract():
    page = """<html><head><title>T</title><script>var a="</p>"</script></head><body><nav><a>Home</a></nav>
    <div class="cookie-notice">We use</div><article><header><h1>A &amp; B</h1></header><p>One <b>two<br>three
    <p>Four<!-- no --></p><div class="comments"><p>Nice</p></div><form><input>Mail</form></article>
    <aside>Side</aside><footer>&copy;</footer></body></html>"""
    assert extract(page, None, set()) == "A & B\nOne two three\nFour"
    assert extract("", None, set()) == "" and extract("plain <i>text", None, set()) == "plain text"


def test_template_takes_ordered_nested_classes():
    def deduced(pages):
        counts = {t: tuple(p.count(t) for p in pages) for p in pages for t in p}
        rows = [{"token": t, "vector": hash(v), "pages": sum(map(bool, v))} for t, v in counts.items()]
        classes, sizes = classes_of(rows)
        seen = {}
        for page in pages:
            for k, (n, low, high) in nesting(page, classes, sizes).items():
                old = seen.get(k, (0, low, high))
                seen[k] = (old[0] + n, min(old[1], low), max(old[2], high))
        return template_of(rows, [{"outer": k[0], "inner": k[1], "times": v[0], "low": v[1], "high": v[2]} for k, v in seen.items()])

    frame, item = ["/h", "/h/a", "/h/b"], ["/h/a/i", "/h/a/i/x", "/h/a/i/y"]
    pages = [[*frame[:2], *item * n, frame[2]] for n in (1, 3, 2)]
    assert deduced(pages) == sorted(frame + item)
    assert deduced([*pages, [*frame[:2], *item * 4, "/h/a/i/y", "/h/a/i", "/h/a/i/x", frame[2]]]) == frame  # out of order
    assert deduced([*pages, [*frame, *item * 4]]) == frame  # in another gap
    assert deduced([*pages, [*frame[:2], *item * 4, *item[:1], frame[2], *item[1:]]]) == frame  # across


def test_tallies_never_exceed_the_difference_of_sets():
    from tidemark.llm.jaccard import tallies, tallies_apart

    rng = np.random.default_rng(3)
    for n in (0, 1, 40, 1000, 5000, 40_000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        for gone in (0, n // 20, n // 3, n):
            x, y = np.unique(base), np.unique(np.concatenate([base[gone:], rng.integers(0, 2**63, gone + n // 9, dtype=np.uint64)]))
            apart = tallies_apart(tallies(x), tallies(y))
            assert apart == tallies_apart(tallies(y), tallies(x)) <= len(np.setxor1d(x, y))
    long, other = (rng.integers(0, 2**63, 30_000, dtype=np.uint64) for _ in range(2))
    assert tallies_apart(tallies(long), tallies(other)) > 10_000  # unlike sets are told apart at any length

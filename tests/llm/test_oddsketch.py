"""Near duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from tidemark.llm import oddsketch

SCHEMA = "doc_id long, text string, n int, sig string, component long"
SPLIT = r"[\x20\x09-\x0D]+"


def shingles(text, k):
    lower = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split(SPLIT, lower) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = root(i), root(j)
                least[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    out = []
    for _ in range(14):
        base = [rng.choice(words) for _ in range(rng.randint(30, 250))]
        out.append(" ".join(base))
        for _ in range(rng.choice([0, 3, 12])):  # copies around the threshold, and chains of them
            copy = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
            if rng.random() < 0.4:
                base = copy
    out += ["", None, " \n\t", "one", "ONE", "one two three", "one two three four", "one two three four five", out[0].upper(), out[0] + "\n", "word " * 5000, "word " * 9000]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("k,percent,stars", [(4, 80, 3), (4, 80, 0), (3, 70, 1)])
def test_against_brute_force(spark, texts, k, percent, stars):
    docs = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = {r.doc_id: r for r in oddsketch.near_classes(docs, k, percent, stars=stars).collect()}
    component, sizes = brute(texts, k, percent)
    assert len(set(component)) < len(texts) - 5
    assert [(got[i].component_id, got[i].n_shingles, got[i].kept) for i in range(len(texts))] == [(c, n, c == i) for i, (c, n) in enumerate(zip(component, sizes))]


def test_odd_tables(spark):
    def run(rows):
        out = oddsketch.near_classes(spark.createDataFrame(rows, SCHEMA), 4, 80).collect()
        return sorted([(r.doc_id, r.component_id, r.kept) for r in out], key=str)

    text = "a b c d e f"
    assert run([]) == []
    assert run([(3, text, 1, "s", 2), (3, text, 1, "s", 2), (5, text, 1, "s", 2)]) == [(3, 3, True), (3, 3, True), (5, 3, False)]
    assert run([(None, text, 1, "s", 2), (7, text, 1, "s", 2), (None, "x y", 1, "s", 2), (None, None, 1, "s", 2)]) == sorted([(None, 7, False), (7, 7, True), (None, None, True), (None, None, True)], key=str)


def test_a_whole_family_of_unlike_copies(spark):
    """Sets alike enough to share bands, but not to link, are all told apart."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for n in range(60):
        copy = list(base)
        for at in rng.sample(range(200), 9):
            copy[at] = f"x{n}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.component_id for r in oddsketch.near_classes(docs, 4, 80).collect()}
    assert [got[i] for i in range(60)] == brute(texts, 4, 80)[0]


def test_sketches_tell_how_many_samples_differ():
    rng = np.random.default_rng(9)
    how = oddsketch.plan(80)
    bits = 64 * oddsketch.WORDS
    for alike in (0.8, 0.9, 0.97):
        values = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
        gone = round(4000 * (1 - alike) / (1 + alike))
        other = np.concatenate([values[gone:], rng.integers(0, 1 << 63, gone).astype(np.uint64)])
        least = oddsketch.min_hashes(np.concatenate([values, other]), np.array([0, 4000]), oddsketch.SAMPLES)
        odd = oddsketch.odd_sketches(least)
        differ = int(np.bitwise_count((odd[0] ^ odd[1]).view(np.uint64)).sum())
        estimate = 1 + bits / (4 * oddsketch.SAMPLES) * np.log(1 - 2 * differ / bits)
        assert abs(estimate - alike) < 0.1 and differ <= how.reach

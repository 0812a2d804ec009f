"""Each operator on small tables against brute force, and on the odd cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, dedup, htmltext, jaccard, lm, mixing, pii, quality, sharding, tokencount

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, key string, __x int"
SPLIT = r"[\x20\x09-\x0D]+"


def words(text):
    lower = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(SPLIT, lower) if w]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base = [prose(rng, rng.randint(60, 160)) for _ in range(12)]
    item = prose(rng, 30)
    texts = base + base[:3] + base[:2]
    for t in base[:6]:
        w = t.split()
        w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += [base[7] + "\n" + item + "\n" + base[8], item.upper(), "", None, "   \n", "one two", "ab " * 400, "é" * 150, "### " * 60]
    texts += ["mail a.b@c.de or x@y.z_d@e.fg, ip 10.0.0.300 1.2.3.4.5, card 4111 1111 1111 1111, +49 (30) 123-4567 tel " + "7" * 40]
    out = [(i, t, ["en", None][i % 2], ["s1", "s2", None][i % 3], 1, "clash", "k", i) for i, t in enumerate(texts)]
    return out + [out[0], (None, base[4], "en", "s1", 1, "clash", "k", 0)], [(1, item), (2, "short item"), (3, None), (4, "")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows[0], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding(docs, rows, nothing):
    out = sharding.shard_by_bytes(docs, 4).collect()
    sizes = collections.Counter()
    slots = collections.defaultdict(list)
    for r in out:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(out) == len(rows[0])
    assert sum(sizes.values()) == sum(len((t or "").encode()) + 8 for _, t, *_ in rows[0])
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in out)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_bytes(nothing).count() == 0


def test_mixing(docs, rows, nothing):
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows[0]) and sorted(map(str, out)) == sorted(map(str, mixing.mix(docs).collect()))
    total = sum(r["size"] for r in out)
    targets = {(r["source_size"], r["target"]) for r in out}
    assert math.isclose(sum(t for _, t in targets), total)
    assert all(t <= 3 * s + 1e-9 for s, t in targets) and all(r["taken"] <= 3 * r["size"] for r in out)
    for size, target in targets:
        taken = sum(r["taken"] for r in out if r["source_size"] == size)
        assert abs(taken - target) <= 2 * max(r["size"] for r in out if r["source_size"] == size)
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert sum(len([w for w in re.split(SPLIT, r["text"] or "") if w]) for r in mixing.mixed_documents(docs).collect()) == sum(r["taken"] for r in out)
    assert mixing.mix(nothing).count() == 0


def test_quality(docs, rows, nothing):
    found = {(r["doc_id"], r["text"]): r["__q"] for r in quality.judged(docs).collect()}
    for doc_id, text, *_ in rows[0]:
        w = [x for x in re.split(SPLIT, text or "") if x]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        times = collections.Counter(grams)
        covered = {j for i, g in enumerate(grams) if times[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        q = found[doc_id, text]
        assert (q["n_words"], q["word_chars"], q["n_dup_lines"], q["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert q["n_symbols"] == sum((text or "").count(c) for c in "#*$%&|<>")
        assert q["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (q["kept"] and q["base_failed"])
    assert quality.quality_filter(docs).columns == docs.columns and quality.quality_filter(nothing).count() == 0


def test_personal_data(docs, rows, nothing):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def passes(kind, m):
        d = re.sub("[^0-9]", "", m)
        luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]

    out = {(r["doc_id"], r["text"]): r for r in pii.find_spans(docs).withColumn("masked", pii.masked(F.coalesce("text", F.lit("")), F.col("__spans"))).collect()}
    for doc_id, text, *_ in rows[0]:
        expected = sorted((m.start(), i, m.end()) for i, k in enumerate(patterns) for m in re.finditer(patterns[k], text or "") if passes(k, m.group()))
        assert [(s["start"], s["rank"] - 1, s["end"]) for s in out[doc_id, text]["__spans"] if s["base"]] == expected
    assert any("[email]" in r["masked"] and "[card]" in r["masked"] for r in out.values())
    assert pii.find_spans(nothing).count() == 0


def test_decontamination(spark, docs, rows, nothing):
    benchmark = spark.createDataFrame(rows[1], "item_id long, text string")
    item = words(rows[1][0][1])
    own = collections.Counter(tuple(item[i : i + 5]) for i in range(len(item) - 4))
    expected = set()
    for doc_id, text, *_ in rows[0]:
        s = [tuple(words(text)[i : i + 5]) for i in range(len(words(text)) - 4)]
        for a in range(max(1, len(s) - sum(own.values()) + 1)):
            c = collections.Counter(s[a : a + sum(own.values())])
            common = sum((c & own).values())
            if common and common / (sum(c.values()) + sum(own.values()) - common) >= 0.8:
                expected.add((doc_id, 1))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()} == expected and expected
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(rows[0]) - sum((r[0], 1) in expected for r in rows[0])
    assert decontaminate.leaks(nothing, benchmark).count() == 0 and decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard(docs, rows, nothing, k, percent):
    sets = []
    for _, text, *_ in rows[0]:
        w = words(text)
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)] if w else []))
    label = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    least = {}
    for i, c in enumerate(label):
        if rows[0][i][0] is not None:
            least[c] = min(least.get(c, 1 << 60), rows[0][i][0])
    expected = sorted(((rows[0][i][0], len(s), least.get(label[i])) for i, s in enumerate(sets)), key=str)
    found = jaccard.jaccard_classes(docs, k, percent)
    assert sorted(((r[0], r[1], r[2]) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=str) == expected
    if k == 5:
        kept = jaccard.one_per_class(docs)
        assert kept.columns == docs.columns
        assert kept.count() == len({label[i] for i, s in enumerate(sets) if s}) + sum(not s for s in sets)
        assert jaccard.jaccard_classes(nothing, k, percent).count() == 0


def test_repeated_passages(docs, rows, nothing):
    data = [(t or "").encode() for _, t, *_ in rows[0]]
    times = collections.Counter(d[p : p + 200] for d in data for p in range(len(d) - 199))
    expected = []
    for (doc_id, *_), d in zip(rows[0], data):
        gone = bytearray(len(d))
        for p in range(len(d) - 199):
            if times[d[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(d, gone) if not g)
        expected.append((doc_id, len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    assert sorted((tuple(r) for r in dedup.remove_repeats(docs).collect()), key=str) == sorted(expected, key=str)
    assert dedup.remove_repeats(nothing).count() == 0


def test_repeated_passages_with_full_buckets(docs):
    # All unlike segments are then counted window by window.
    whole = sorted(map(str, dedup.remove_repeats(docs).collect()))
    assert sorted(map(str, dedup.remove_repeats(docs, bucket=1).collect())) == whole


def test_language_model(docs, rows, nothing):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(i, words(t) + [None]) for i, t, *_ in rows[0]]
    one = collections.Counter(w for i, ws in tokens if not held(i) for w in ws)
    two = collections.Counter(p for i, ws in tokens if not held(i) for p in zip([None, *ws], ws))
    n, v = sum(one.values()), len(one)
    base = lambda w: (one[w] + 1) / (n + v + 1)
    expected = sorted((str(i), len(ws), sum(one[w] > 0 for w in ws), n, sum(math.log10(base(w)) for w in ws),
                       sum(math.log10((two[a, b] + 500 * base(b)) / (one[a] + 500)) for a, b in zip([None, *ws], ws))) for i, ws in tokens)
    found = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in lm.score_texts(docs).collect())
    for a, b in zip(expected, found, strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=2e-3)
    assert lm.score_texts(nothing).count() == 0


def test_token_counts(docs, rows, nothing):
    out = tokencount.count_tokens(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in out) == sorted((str(i), len([w for w in re.split(SPLIT, t or "") if w])) for i, t, *_ in rows[0])
    assert all(r["n_tokens"] >= r["n_words"] for r in out) and tokencount.count_tokens(nothing).count() == 0


def test_main_text(spark):
    frame = "<html><body><nav><a>Home {n}</a></nav><div class='x'>Always the same</div><div class='y'><p>Text {n}</p></div></body></html>"
    pages = [(i, "http://h.example/" + str(i), frame.format(n=i), "clash") for i in range(6)] + [(7, None, None, "c"), (8, "nope", "<p>a&nbsp;b", "c"), (0, "http://h.example/0", frame.format(n=0), "c")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    out = {r["page_id"]: r for r in htmltext.main_text(table).collect()}
    assert out[3]["text"] == "Text 3" and out[3]["n_chars"] == 6
    assert out[7]["text"] == "" and out[8]["text"] == "a b"
    assert htmltext.main_text(table).count() == len(pages) and htmltext.main_text(table.limit(0)).count() == 0


def test_main_text_keeps_paragraphs_whose_count_varies(spark):
    frame = "<html><body><div class='content'><h1>Title {n}</h1>{p}</div><div class='z'>Same words</div></body></html>"
    pages = [(i, f"http://v.example/{i}", frame.format(n=i, p="".join(f"<p>Text {i}.{j}</p>" for j in range(i + 1)))) for i in range(5)]
    out = {r["page_id"]: r["text"] for r in htmltext.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out == {i: "\n".join([f"Title {i}", *[f"Text {i}.{j}" for j in range(i + 1)]]) for i in range(5)}


def test_main_text_below_wrappers(spark):
    body = "<nav>Home</nav>{a}<article><h1>Title {n}</h1><p>Some text {n}</p></article>{b}<div class='site-footer'>Imprint {n}</div>"
    wrappers = ["<form>", "<div class='has-sidebar'>", "<div id='no-sidebar'>", "<div class='header-fixed'>", "<div class='social-layout'>", "<div class='page-widget'>"]
    pages = [(i, f"http://w{i}.example/", w + body.format(n=i, a="", b="") + f"</{w[1:4]}" + ">" * (i > 0)) for i, w in enumerate(wrappers)]
    plain = "<form><div class='has-sidebar'><p>Plain text {n}, rather long</p><div class='site-footer'>Imprint {n}</div></div></form>"
    pages += [(10 + i, "http://plain.example/", plain.format(n=i)) for i in range(4)]
    teasers = "<div class='article-list'>More {n}</div><div class='z'><p>The long text of page {n}</p></div><div class='related-posts'><article>Other {n}</article></div>"
    pages += [(20 + i, "http://teasers.example/", teasers.format(n=i)) for i in range(4)]
    out = {r["page_id"]: r["text"] for r in htmltext.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"Title {i}\nSome text {i}" for i in range(len(wrappers)))
    assert all(out[10 + i] == f"Plain text {i}, rather long" for i in range(4))
    assert all(f"The long text of page {i}" in out[20 + i] and "Other" not in out[20 + i] for i in range(4))


def test_main_text_leaves_link_slots_and_weighs_articles(spark):
    links = "<html><body><div class='k'>{a}</div><div class='c'><h1>Title {n}</h1><p>Some text {n}</p></div></body></html>"
    pages = [(i, "http://links.example/", links.format(n=i, a="".join(f"<a>Story {i}{j}</a>" for j in range(3)))) for i in range(4)]
    teasers = "<html><body><div class='article'>More {n}</div><div class='c'><h1>Title {n}</h1><p>The long text of page {n}</p></div></body></html>"
    pages += [(10 + i, "http://teasers.example/", teasers.format(n=i)) for i in range(4)]
    out = {r["page_id"]: r["text"] for r in htmltext.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"Title {i}\nSome text {i}" for i in range(4))
    assert all(out[10 + i] == f"More {i}\nTitle {i}\nThe long text of page {i}" for i in range(4))


def test_decontamination_of_scattered_hits_takes_bounded_parts(monkeypatch):
    from tidemark.llm.bytewords import shingles_of, text_slices, words_of

    items = [" ".join(f"{c}{i}" for i in range(20)) for c in "ab"]
    index = decontaminate.ItemIndex([1, 2], items)
    text = " ".join([items[0], *(f"x{i}" for i in range(50_000)), items[1]])
    _, data, offsets = next(iter(text_slices(pa.array([text]))))
    hashes = shingles_of(words_of(data, offsets), 5).hash
    taken, signs = [], decontaminate.signs
    monkeypatch.setattr(decontaminate, "signs", lambda h: taken.append(len(h)) or signs(h))
    hits = np.flatnonzero(np.isin(hashes, index.keys))
    assert index.leaks_in(hashes, 5, hits) == {0: (1.0, 0, 20), 1: (1.0, 50_020, 20)}
    assert max(taken) < 5_000 < len(hashes)


def test_jaccard_compares_repeated_rows_once(spark, monkeypatch):
    near = " ".join(f"w{i}" for i in range(60))
    table = spark.createDataFrame([(1, near)] * 7 + [(None, near + " end")] * 5, "doc_id long, text string")
    kept, written = [], jaccard.written

    def counted(df, purpose):
        out = written(df, purpose)
        if purpose == "jaccard-sets":
            kept.append((out.count(), out.select("sig").distinct().count()))
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    found = jaccard.jaccard_classes(table, 3, 90).collect()
    assert len(found) == 12 and {r["component_id"] for r in found} == {1} and max(kept) == (2, 2) and all(a == b for a, b in kept)

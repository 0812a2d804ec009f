"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities
come from expectation maximisation, and a span classifier is trained on the result."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.binding import let, with_once
from tidemark.llm.store import free_name

KINDS = ("email", "ip", "card", "phone")
# The base patterns. They are written so that no match is tried twice
# (possessive repeats, and a start only where a run begins or the last match ended).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried on it.
NEEDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: t.contains("+"),
}
# Further candidates, each judged by the labelers: telephone numbers without a country code,
# addresses written out, keys and tokens.
MORE = {
    "local_phone": (r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", lambda t: t.rlike("[0-9]{3}[ .-][0-9]{4}")),
    "written_email": (r"[A-Za-z0-9._%+-]{2,64} ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]{2,64} ?(?:[(\[] ?dot ?[)\]]|\.) ?[A-Za-z]{2,12}", lambda t: t.rlike(r"[(\[] ?at ?[)\]]")),
    "secret": (r"(?<![A-Za-z0-9_-])(?:[0-9a-f]{32,128}|(?:AKIA|ghp_|sk-)[A-Za-z0-9]{16,64})(?![A-Za-z0-9_-])", lambda t: t.rlike("[0-9a-f]{32}|AKIA|ghp_|sk-")),
}
ALL_KINDS = (*KINDS, *MORE)
# Gazetteers: endings of domains, first digits of card issuers, country calling codes.
DOMAIN_ENDINGS = ("com", "org", "net", "edu", "gov", "io", "info", "biz", "de", "fr", "es", "uk", "eu", "us", "it", "nl", "ch", "at")
CONTEXT_CHARS = 40
CONTEXT = {
    "email": r"(?i)mail|contact|write|@|from|to:",
    "ip": r"(?i)\bip\b|host|server|address|addr",
    "card": r"(?i)card|visa|master|amex|credit|payment",
    "phone": r"(?i)phone|tel|call|fax|mobile",
    "local_phone": r"(?i)phone|tel|call|fax|mobile",
    "written_email": r"(?i)mail|contact|write",
    "secret": r"(?i)token|key|secret|passw|auth",
}
LABELERS = ("pattern", "gazetteer", "context")
PRIOR = 0.5
ROUNDS = 50


def matches_of(text: Column, pattern: str, kind: str) -> Column:
    """Array of (kind, start, end, match) in code points, of a text that is not null.

    The pieces between the matches give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def placed(m: Column, gaps: Column) -> Column:
        empty = F.array().cast("array<struct<kind:string,start:int,end:int,match:string>>")
        step = lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
            F.array_append(acc["spans"], F.struct(
                F.lit(kind).alias("kind"), (acc["at"] + x["gap"]).alias("start"),
                (acc["at"] + x["gap"] + F.length(x["m"])).alias("end"), x["m"].alias("match"))).alias("spans"))
        pairs = F.zip_with(m, F.slice(gaps, F.lit(1), F.size(m)), lambda a, g: F.struct(a.alias("m"), F.length(g).alias("gap")))
        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)["spans"]

    return let(found, lambda m: placed(m, pieces))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """The check that a base match must pass."""
    if kind == "ip":
        # A part of any length is at most 255 if at most three digits remain without zeros.
        return F.forall(F.split(match, r"\."), lambda p: let(
            F.ltrim(p, F.lit("0")), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))))
    if kind == "card":
        return let(_digits(match), lambda d: F.length(d).between(12, 19) & luhn(d))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _vote(kind: str, match: Column) -> tuple[Column, Column]:
    """Votes of the pattern and gazetteer labelers: 1 yes, 0 no, -1 abstains."""
    yes, no, none = F.lit(1), F.lit(0), F.lit(-1)
    digits = _digits(match)
    if kind in ("email", "written_email"):
        ending = F.lower(F.regexp_extract(match, r"([A-Za-z]+)$", 1))
        plain = match.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*[ (\[@]")
        return F.when(plain, yes).otherwise(no), F.when(ending.isin(*DOMAIN_ENDINGS), yes).otherwise(none)
    if kind == "ip":
        return F.when(valid(kind, match), yes).otherwise(no), F.when(match.rlike(r"^(?:0|127|255)\."), no).otherwise(none)
    if kind == "card":
        return F.when(valid(kind, match), yes).otherwise(no), F.when(digits.rlike("^[3-6]"), yes).otherwise(none)
    if kind == "phone":
        return F.when(valid(kind, match), yes).otherwise(no), F.when(match.rlike(r"^\+(?:1|33|34|44|49)[^0-9]"), yes).otherwise(none)
    if kind == "local_phone":
        return F.when(match.rlike(r"^\("), yes).otherwise(none), F.when(digits.rlike("^[01]"), no).otherwise(none)
    mixed = match.rlike("[0-9]") & match.rlike("[a-zA-Z]")
    return F.when(mixed, yes).otherwise(no), F.when(match.rlike("^(?:AKIA|ghp_|sk-)"), yes).otherwise(none)


def _described(text: Column, kind: str) -> Callable[[Column], Column]:
    def described(m: Column) -> Column:
        match = m["match"]
        before = F.substring(text, F.greatest(m["start"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT_CHARS)))
        context = F.when(before.rlike(CONTEXT[kind]), F.lit(1)).otherwise(F.lit(-1))
        features = [F.least(F.length(match) / 8, F.lit(5)).cast("int"), F.when(match.rlike("[ .()-]"), 1).otherwise(0),
                    F.least(F.length(_digits(match)) / 4, F.lit(5)).cast("int")]
        base = valid(kind, match) if kind in BASE else F.lit(False)
        parts = [c.cast("string") for c in (*_vote(kind, match), context, *features)]
        return F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                        base.alias("base"), F.concat_ws("|", F.lit(kind), *parts).alias("key"))

    return described


def candidates(text: Column) -> Column:
    """All candidate spans of a text: (kind, start, end, base, key). ``key`` holds the votes
    and the classifier's features, as ``kind|votes|features``."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,base:boolean,key:string>>")
    parts = []
    for kind in ALL_KINDS:
        pattern, needs = (BASE[kind], NEEDS[kind]) if kind in BASE else MORE[kind]
        parts.append(F.when(needs(text), F.transform(matches_of(text, pattern, kind), _described(text, kind))).otherwise(none))
    return F.concat(*parts)


def fit_label_model(counts: dict[tuple[str, tuple[int, ...]], float]) -> dict[tuple[str, tuple[int, ...]], float]:
    """Probability that a span is personal data, by (kind, votes), from the counts of vote
    patterns. Labelers are taken as independent given the truth; each has, per kind, a rate
    of yes among true and among false spans, found by expectation maximisation."""
    posterior = {}
    for kind in {k for k, _ in counts}:
        own = {v: n for (k, v), n in counts.items() if k == kind}
        right, wrong, prior = [0.9] * len(LABELERS), [0.2] * len(LABELERS), PRIOR
        p: dict[tuple[int, ...], float] = {}
        for _ in range(ROUNDS):
            for votes in own:
                a, b = math.log(prior), math.log(1 - prior)
                for j, v in enumerate(votes):
                    if v >= 0:
                        a += math.log(right[j] if v else 1 - right[j])
                        b += math.log(wrong[j] if v else 1 - wrong[j])
                p[votes] = 1 / (1 + math.exp(min(700.0, b - a)))
            total = sum(own.values())
            prior = (sum(n * p[v] for v, n in own.items()) + 1) / (total + 2)
            for j in range(len(LABELERS)):
                voted = {v: n for v, n in own.items() if v[j] >= 0}
                # Pseudo-counts keep labelers better than chance where data are few.
                right[j] = (sum(n * p[v] for v, n in voted.items() if v[j]) + 9) / (sum(n * p[v] for v, n in voted.items()) + 10)
                wrong[j] = (sum(n * (1 - p[v]) for v, n in voted.items() if v[j]) + 2) / (sum(n * (1 - p[v]) for v, n in voted.items()) + 10)
        posterior |= {(kind, v): q for v, q in p.items()}
    return posterior


def train_classifier(rows: list[tuple[str, float]]) -> dict[str, float]:
    """Final probability by key: naive Bayes over the features of a span and its context
    vote, with the label model's probabilities as soft labels."""
    parsed = {key: (parts[0], tuple(map(int, parts[1:4])), tuple(map(int, parts[3:]))) for key, _ in rows for parts in [key.split("|")]}
    votes: dict[tuple[str, tuple[int, ...]], float] = {}
    for key, n in rows:
        kind, v, _ = parsed[key]
        votes[kind, v] = votes.get((kind, v), 0.0) + n
    label = fit_label_model(votes)
    yes: dict[tuple, float] = {}
    no: dict[tuple, float] = {}
    for key, n in rows:
        kind, v, features = parsed[key]
        q = label[kind, v]
        for item in [(kind,), *[(kind, i, f) for i, f in enumerate(features)]]:
            yes[item] = yes.get(item, 0.0) + n * q
            no[item] = no.get(item, 0.0) + n * (1 - q)
    out = {}
    for key, _ in rows:
        kind, v, features = parsed[key]
        # The label model's odds are the prior; the features move them.
        q = min(max(label[kind, v], 1e-9), 1 - 1e-9)
        odds = math.log(q / (1 - q))
        for i, f in enumerate(features):
            odds += math.log((yes[kind, i, f] + 1) / (yes[(kind,)] + 6)) - math.log((no[kind, i, f] + 1) / (no[(kind,)] + 6))
        out[key] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
    return out


def fit(docs: DataFrame, text_column: str = "text") -> list[str]:
    """Keys of candidate spans that the trained classifier takes for personal data.

    Counts all candidates of all documents by key. Keys are combinations of seven kinds,
    three votes and three small features, so at most some thousands reach the driver,
    whatever the input."""
    spans = docs.select(F.explode(candidates(F.coalesce(F.col(text_column), F.lit("")))).alias("s"))
    counts = spans.groupBy(F.col("s.key").alias("key")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted(k for k, p in train_classifier([(r["key"], float(r["n"])) for r in counts]).items() if p > 0.5)


def find_spans(docs: DataFrame, text_column: str = "text", accepted: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` and ``__spans``: array of (start, rank, kind, end, base),
    sorted by start, then kind as listed in ``ALL_KINDS``. Base spans are always in it, other
    candidates if the classifier takes them and no base span overlaps them.

    Null and empty texts: no spans. Repeated rows: treated alike. Empty input: no rows, and a
    classifier that takes nothing. Columns of any name stay, but for an earlier ``__spans``.
    """
    keys = fit(docs, text_column) if accepted is None else accepted
    text = F.coalesce(F.col(text_column), F.lit(""))
    all_of, base_of = free_name(docs, "__c"), free_name(docs, "__b")
    found = with_once(docs, {all_of: candidates(text)})
    found = with_once(found, {base_of: F.filter(all_of, lambda s: s["base"])})
    known = F.array(*[F.lit(k) for k in keys]).cast("array<string>")
    apart = lambda s: ~F.exists(base_of, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    taken = F.filter(all_of, lambda s: s["base"] | (F.array_contains(known, s["key"]) & apart(s)))
    ranks = F.array(*[F.lit(k) for k in ALL_KINDS])
    ordered = F.sort_array(F.transform(taken, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(ranks, s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))))
    return found.withColumn("__spans", ordered).drop(all_of, base_of)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span that does not begin inside an earlier one replaced by its
    kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
        s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out")))
    return let(F.aggregate(spans, start, step), lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))

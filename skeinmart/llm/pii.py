"""Personal data by fixed patterns and by boosted trees over proposed spans; DataFrame functions only.

The fixed patterns give the base spans. Generators of high recall propose further
spans, which may overlap each other. Gradient-boosted trees judge a proposal by
features of its format and context. They learn from all documents: the proposals are
counted by feature values (a table of bounded size, since every feature has a few
values). Examples are those that coincide with base spans, and those with evidence of
their own that the fixed patterns do not ask for (``evident``). Per kind the threshold
is calibrated on other documents than the trees saw, so that at least ``PRECISION`` of
the proposals above it are examples; a kind for which no threshold does gets none added.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import fold, quoted, unused_name, whole_text

KINDS = ["email", "ip", "card", "phone"]

# What the contract's patterns match, written so that long runs take linear time: a
# possessive quantifier where what follows cannot overlap, and a start at the head of a
# run (or where the last match ended), from where the leftmost match always begins.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|[(\[{]\x20?(?i:at)\x20?[)\]}])\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|[(\[{]\x20?(?i:dot)\x20?[)\]}])\x20?[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9A-Za-z.:])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){3}|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4})(?![0-9A-Za-z:]|\.[0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20._-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){2,5}(?![0-9A-Za-z])",
}
# Cheap tests without which a pattern cannot match.
NEEDS = {
    "email": r"@|[(\[{]\x20?(?i:at)",
    "ip": r"[0-9]\.[0-9]++\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]",
    "card": r"[0-9](?:[\x20._-]?[0-9]){11}",
    "phone": r"\+[0-9]|[0-9]\)?[\x20./-]{1,2}\(?[0-9]{2}",
}
KEYWORDS = r"(?i)phone|tel|call|fax|mobile|mail|contact|card|visa|credit|\bip\b|server|host|address|account|write"
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CONTEXT = 24
# Words before a proposal that speak for its kind.
SPEAKS = {"card": r"(?i)card|visa|credit", "phone": r"(?i)phone|\btel|\bcall|\bfax|mobile"}
IPV6 = "^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$"
ADDRESS = r"^[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}$"

# Every feature has few values, so that their combinations stay countable on the driver.
FEATURES = ["digits", "groups", "mark", "luhn", "octets", "keyword", "next", "tail", "form"]
FOLDS, FIT_FOLDS = 4, (0, 1)
ROUNDS, RATE = 20, 0.3
PRECISION, SUPPORT = 0.98, 50


# No pattern matches a text without one of these.
SIGNS = r"[0-9@(\[{]"


def found(text: str, kind: str, pattern: str, gate: Column) -> Column:
    """array<struct<kind, start, stop, m, before, after>> of a pattern's matches, leftmost and not overlapping, where ``gate`` holds.

    The parts between the matches give the positions: code points, end exclusive.
    """
    t = F.col(text)
    empty = F.array().cast("array<struct<kind:int,start:int,stop:int,m:string,before:string,after:string>>")

    def step(acc, part, i):
        start = acc["pos"] + F.length(part["s"])
        span = F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            start.alias("start"),
            (start + F.length(part["m"])).alias("stop"),
            part["m"].alias("m"),
            F.right(part["s"], F.lit(CONTEXT)).alias("before"),
            F.left(F.coalesce(part["next"], F.lit("")), F.lit(1)).alias("after"),
        )
        return F.struct((start + F.length(part["m"])).alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    matches, gaps = F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.split(t, pattern, -1)
    zipped = F.arrays_zip(matches.alias("m"), gaps.alias("s"), F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))).alias("next"))
    zipped = F.filter(zipped, lambda p: p["m"].isNotNull())
    zero = F.struct(F.lit(0).alias("pos"), empty.alias("out"))
    fold_ = F.reduce(zipped, zero, lambda acc, p: step(acc, p, None), lambda acc: acc["out"])
    return F.when(gate & F.rlike(t, F.lit(NEEDS[kind])), fold_).otherwise(empty)


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes the check sum; false for the empty string."""

    def add(acc, i):
        x = F.substring(d, i, F.lit(1)).cast("int")
        double = (F.length(d) - i) % 2 == 1
        return acc + F.when(double, x * 2 - F.when(x >= 5, 9).otherwise(0)).otherwise(x)

    return (F.length(d) > 0) & (F.reduce(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), add) % 10 == 0)


def holds(kind: str, m: Column) -> Column:
    d = digits_of(m)
    if kind == "ip":
        return F.rlike(m, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    if kind == "card":
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(d).between(10, 15)
    return F.lit(True)


def passing(kind: str):
    return lambda s: holds(kind, s["m"])


def of_kind(number: int):
    return lambda s: s["kind"] == number


def ordered(spans: Column) -> Column:
    """By start, then kind, then stop."""
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")


def undone(m: Column) -> Column:
    """An address with (at) and [dot] as the signs they stand for."""
    m = F.regexp_replace(m, r"(?i)\x20?[(\[{]\x20?at\x20?[)\]}]\x20?", "@")
    return F.regexp_replace(m, r"(?i)\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?", ".")


def formed(p: Column) -> Column:
    """Whether a proposal reads as an address that is spelled out, or as a full IPv6 address."""
    email = (p["kind"] == KINDS.index("email")) & F.rlike(undone(p["m"]), F.lit(ADDRESS))
    return email | (p["kind"] == KINDS.index("ip")) & F.rlike(p["m"], F.lit(IPV6))


def evident(p: Column) -> Column:
    """Whether a proposal is real by evidence that needs no base span.

    Addresses: by syntax. Cards: the check sum, and under 14 digits also a word that
    speaks for a card. Phones: 10 to 15 digits, as the base pattern has after a plus
    sign, and a word that speaks for a phone.
    """
    d = digits_of(p["m"])
    said = {k: F.rlike(p["before"], F.lit(v)) for k, v in SPEAKS.items()}
    card = F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False) & ((F.length(d) >= 14) | said["card"])
    phone = F.length(d).between(10, 15) & said["phone"]
    return formed(p) | (p["kind"] == KINDS.index("card")) & card | (p["kind"] == KINDS.index("phone")) & phone


def bucket(c: Column, *bounds: int) -> Column:
    """Number of bounds that are at most the value."""
    return sum((F.when(c >= b, 1).otherwise(0) for b in bounds), F.lit(0))


def judged(p: Column) -> Column:
    """A proposal with its features."""
    m = p["m"]
    d = digits_of(m)
    inside = F.regexp_replace(m, r"[0-9A-Za-z()+]", "")
    first = F.left(inside, F.lit(1))
    tail = F.length(F.regexp_extract(m, r"[A-Za-z]+$", 0))
    values = {
        "digits": bucket(F.length(d), 4, 8, 10, 12, 14, 16, 17),
        "groups": bucket(F.size(F.split(m, "[0-9]+", -1)), 2, 3, 4, 5, 6, 8),
        "mark": F.when(first == "", 0).when(first == " ", 1).when(first == "-", 2).when(first == ".", 3).otherwise(4),
        "luhn": F.when(F.length(d).between(12, 19), luhn(d).cast("int")).otherwise(0),
        "octets": F.rlike(m, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$")).cast("int"),
        "keyword": F.rlike(p["before"], F.lit(KEYWORDS)).cast("int"),
        "next": F.when(p["after"] == "", 0).when(F.rlike(p["after"], F.lit("[0-9A-Za-z]")), 1).when(F.rlike(p["after"], F.lit(r"\s")), 2).otherwise(3),
        "tail": bucket(tail, 1, 2, 3, 5),
        "form": formed(p).cast("int"),
    }
    return F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["stop"].alias("stop"), evident(p).alias("evident"), *(values[f].cast("int").alias(f) for f in FEATURES))


def proposals(docs: DataFrame, text: str, base: str, out: str) -> DataFrame:
    """Adds the array ``base`` of base spans, and ``out`` of proposals with features and label.

    Label 3: a base span; 2: touches one; 1: another with evidence; 0: another without.
    """
    names = {(w, k): unused_name(docs, f"{w}_{k}") for w in ("b", "p") for k in KINDS}
    gate = unused_name(docs, "may_match")
    df = docs.withColumn(gate, F.rlike(F.col(text), F.lit(SIGNS)))
    patterns = {"b": BASE, "p": PROPOSED}
    df = df.withColumns({names[w, k]: found(text, k, p[k], F.col(gate)) for w, p in patterns.items() for k in KINDS})
    kept = [F.filter(F.col(names["b", k]), passing(k)) for k in KINDS]
    df = df.withColumn(base, ordered(F.concat(*kept)))
    # Most documents propose nothing, and then no feature is computed.
    every = F.concat(*(F.transform(F.col(names["p", k]), judged) for k in KINDS))
    spans = F.col(base)

    def label(p):
        same = F.exists(spans, lambda s: (s["start"] == p["start"]) & (s["stop"] == p["stop"]) & (s["kind"] == p["kind"]))
        touch = F.exists(spans, lambda s: (s["start"] < p["stop"]) & (p["start"] < s["stop"]))
        return F.struct(*(p[f].alias(f) for f in ["kind", "start", "stop", *FEATURES]), F.when(same, 3).when(touch, 2).otherwise(p["evident"].cast("int")).alias("label"))

    return df.withColumn(out, F.transform(every, label)).drop(gate, *names.values())


Tree = tuple  # (feature, bound, left, right) or a leaf value; left is taken where the feature is at most the bound


def grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int):
    """A regression tree on weighted cells by second-order gain."""

    def gain(m):
        return grad[m].sum() ** 2 / (hess[m].sum() + 1.0)

    best = (1e-6, None, None)
    for f in range(x.shape[1] if depth else 0):
        for b in np.unique(x[:, f])[:-1]:
            m = x[:, f] <= b
            g = gain(m) + gain(~m) - gain(np.ones(len(x), bool))
            if g > best[0]:
                best = (g, f, b)
    _, f, b = best
    if f is None:
        return float(RATE * grad.sum() / (hess.sum() + 1.0))
    m = x[:, f] <= b
    return (f, int(b), grow(x[m], grad[m], hess[m], depth - 1), grow(x[~m], grad[~m], hess[~m], depth - 1))


def value(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, b, left, right = tree
    return np.where(x[:, f] <= b, value(left, x), value(right, x))


def as_column(tree, p: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    f, b, left, right = tree
    return F.when(p[["kind", *FEATURES][f]] <= b, as_column(left, p)).otherwise(as_column(right, p))


def boost(x: np.ndarray, yes: np.ndarray, no: np.ndarray) -> list:
    """Logistic boosting on cells that hold ``yes`` and ``no`` examples."""
    trees, score = [], np.zeros(len(x))
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        n = yes + no
        tree = grow(x, yes - n * p, n * p * (1 - p), 3)
        trees.append(tree)
        score += value(tree, x)
    return trees


def fit(judged_docs: DataFrame, id_col: str, out: str) -> tuple[list, dict[int, float]]:
    """Trees, and the calibrated threshold of each kind that has one."""
    cells = (
        judged_docs.select(F.coalesce(fold(id_col, FOLDS), F.lit(0)).alias("fold"), F.explode(out).alias("p"))
        .where("p.label <> 2")
        .groupBy("p.kind", *(f"p.{f}" for f in FEATURES), F.col("fold").isin(*FIT_FOLDS).alias("fit"))
        .agg(F.count_if(F.col("p.label") > 0).alias("yes"), F.count_if(F.col("p.label") == 0).alias("no"))
        .collect()  # at most one row for each combination of feature values
    )
    cells = sorted(cells)
    learn = [c for c in cells if c.fit]
    if not any(c.yes for c in learn) or not any(c.no for c in learn):
        return [], {}
    table = lambda rows: (np.array([r[: 1 + len(FEATURES)] for r in rows]), np.array([r.yes for r in rows]), np.array([r.no for r in rows]))
    trees = boost(*table(learn))
    held = [c for c in cells if not c.fit]
    if not held:
        return trees, {}
    x, yes, no = table(held)
    score = sum(value(t, x) for t in trees)
    limits = {}
    for kind in range(len(KINDS)):
        own = np.flatnonzero(x[:, 0] == kind)
        order = own[np.argsort(-score[own], kind="stable")]
        right, wrong = np.cumsum(yes[order]), np.cumsum(no[order])
        last = np.append(score[order][1:] < score[order][:-1], True)[: len(order)]  # cells of equal score go together
        good = np.flatnonzero((right >= PRECISION * (right + wrong)) & (right >= SUPPORT) & last)
        if len(good):
            limits[kind] = float(score[order[good[-1]]])
    return trees, limits


def with_spans(docs: DataFrame, id_col: str, text: str, base: str, every: str) -> DataFrame:
    """Adds ``base`` (base spans) and ``every`` (those and the added ones), each ordered."""
    out = unused_name(docs, "proposals")
    return judged_spans(proposals(docs, text, base, out), id_col, base, out, every)


def judged_spans(judged_docs: DataFrame, id_col: str, base: str, out: str, every: str) -> DataFrame:
    """Replaces the proposals ``out`` by ``every``: the base spans and the proposals that the trees choose, ordered."""
    trees, limits = fit(judged_docs.select(F.col(id_col), F.col(out)), id_col, out)
    if not limits:
        return judged_docs.withColumn(every, F.col(base)).drop(out)

    def chosen(p):
        score = sum((as_column(t, p) for t in trees), F.lit(0.0))
        limit = F.lit(float("inf"))
        for kind, bound in limits.items():
            limit = F.when(p["kind"] == kind, F.lit(bound)).otherwise(limit)
        return (p["label"] < 2) & (score >= limit - 1e-9)

    added = F.filter(F.col(out), chosen)
    # Of added spans that overlap, the first stays.
    def first(acc, s):
        return F.when(F.exists(acc, lambda a: (a["start"] < s["stop"]) & (s["start"] < a["stop"])), acc).otherwise(F.concat(acc, F.array(s)))

    joined = F.when(F.size(added) == 0, F.col(base)).otherwise(ordered(F.reduce(ordered(added), F.col(base), first)))
    return judged_docs.withColumn(every, joined).drop(out)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans of every row.

    A null text is empty and has no span. Spans are written kind:start:end in code
    points. Rows are independent of each other but for the trees, which learn from all
    of them; repeated rows count as often as they occur, null ids belong to the rows
    the trees are fitted on. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("t"))
    # The trees and the result both read the spans found: written, so that the texts are searched once.
    judged_docs = materialize(proposals(rows, "t", "base", "proposals").drop("t"), "proposals")
    df = judged_spans(judged_docs, "doc_id", "base", "proposals", "every")
    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return df.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("every")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with every span of the text replaced by its kind, as in [EMAIL]; all else unchanged.

    Spans that overlap are replaced as one, by the kind of the first. A null text stays null.
    """
    text, base, every = (unused_name(docs, n) for n in ("whole_text", "base_spans", "every_span"))
    df = with_spans(docs.withColumn(text, whole_text(text_col)), id_col, text, base, every)
    t, names = F.col(text), F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def step(acc, s):
        fresh = F.struct(
            F.greatest(acc["pos"], s["stop"]).alias("pos"),
            F.concat(acc["out"], F.substring(t, acc["pos"] + 1, s["start"] - acc["pos"]), names[s["kind"]]).alias("out"),
        )
        more = F.struct(F.greatest(acc["pos"], s["stop"]).alias("pos"), acc["out"].alias("out"))
        return F.when((s["start"] < acc["pos"]) & (acc["pos"] > 0), more).otherwise(fresh)

    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    rest = F.length(t)
    clean = F.reduce(F.col(every), zero, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["pos"] + 1, rest)))
    clean = F.when(F.size(every) == 0, F.col(text_col)).otherwise(clean)
    return df.withColumn(text_col, clean).select(*quoted(docs))

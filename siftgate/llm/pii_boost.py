"""Personal data: fixed patterns, and further candidates selected by gradient boosting; DataFrame functions only.

Base spans (email, ip, card, phone) come from fixed patterns and checks and always stay. High-recall generators propose
looser spans of the same kinds. Only candidates outside all base spans are labelled: positive if a check holds that is no
feature (``proved``: check digits of cards, ranges of addresses, top-level domains, a contact word before a phone). Base spans
rewritten into loose forms (plus removed, (at) and (dot), dots in cards) are further positives in training. Boosted
trees of two splits learn from format and context; for each kind a threshold calibrated on held-out candidates outside base
spans (precision of ``PRECISION`` or more by that check) selects; of overlapping selections the likeliest stays.

Scale: two passes without shuffle of texts. All features are small classes, so training needs only one count per
combination (at most ``CELLS`` rows, whatever the input) on the driver, and the trees are applied as a literal of ``CELLS``
probabilities. Defined cases: null text is empty; texts without candidates give no spans; rows with equal doc_id are
handled one by one; extra columns are ignored; patterns are possessive, so long runs of digits or letters cost linear time.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from siftgate.llm.columns import let, scalar, whole

KINDS = ("email", "ip", "card", "phone")
NAME = "[A-Za-z0-9._%+-]"
#: Fixed patterns; the look-behinds only keep a run from being tried again inside itself.
BASE = {
    "email": rf"(?:\G|(?<!{NAME})){NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?:\G|(?<!{NAME})){NAME}++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9])[0-9]++(?:[.:][0-9]++){3,7}+",
    "card": r"[0-9](?:[\x20.-]?[0-9]){11,18}+",
    "phone": r"(?<![0-9])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,15}+",
}
NEED = {"email": r"@|[(\[]at", "ip": r"[0-9][.:][0-9]", "card": r"[0-9]", "phone": r"[0-9]"}
BASE_NEED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]"}
SIZES = (4, 6, 4, 4, 2, 3, 2)   #: classes of each feature: kind, length, separators, groups, letter beside, word before, first digit
CELLS = int(np.prod(SIZES))
PRECISION = 0.95
LEAST = 20                      #: held-out candidates that a threshold needs
CONTACT = "(?:mail|tel|phone|fon|call|card|ip|contact|mobile|fax)[^a-z0-9]*$"
PHONE = "(?:tel|phone|fon|call|contact|mobile|fax)[^a-z0-9]*$"
RECORD = r"(?:\b(?:id|no|nr|ref)|order|number|invoice|isbn|version|build|date|code)[^a-z0-9]*$"
TOP = "(?i)[.)\\]]\\x20?(?:com|org|net|edu|gov|int|mil|info|biz|dev|app|example|test|io|co|eu|de|at|ch|fr|es|it|nl|be|uk|us|ca|au|pl|se|no|dk|fi|pt|ie|jp|cn|in|br|ru)$"
SPAN = "array<struct<start:int,end:int,kind:int,body:string>>"


def found(text: Column, pattern: str, need: str, kind: int) -> Column:
    """Leftmost non-overlapping matches with their places in characters, by the lengths of what is between them."""
    def places(parts: Column) -> Column:
        def step(state: Column, m: Column) -> Column:
            start = state["at"] + F.char_length(F.get(parts["gaps"], F.size(state["spans"])))
            span = F.struct(start.alias("start"), (start + F.char_length(m)).alias("end"), F.lit(kind).alias("kind"), m.alias("body"))
            return F.struct((start + F.char_length(m)).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))
        return F.aggregate(parts["hits"], F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")), step, lambda s: s["spans"])

    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(text.rlike(need), let(parts, places)).otherwise(F.array().cast(SPAN))


def digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Check digit test of a string of digits."""
    worth = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))))
    return F.aggregate(F.filter(worth, lambda x: x.isNotNull()), F.lit(0), lambda s, x: s + x) % 10 == 0


def valid(kind: str, body: Column) -> Column:
    """Whether the parts of an address are in range, the digits of a card have their check digit, a phone has digits enough."""
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(body, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    n = F.length(digits(body))
    return (n >= 14) & (n <= 19) & luhn(digits(body)) if kind == "card" else (n >= 10) & (n <= 15)


def base_spans(text: Column) -> Column:
    """All base spans, by start and then kind."""
    def checked(kind: str):
        return lambda s: valid(kind, s["body"])

    spans = []
    for k, kind in enumerate(KINDS):
        all_ = found(text, BASE[kind], BASE_NEED[kind], k)
        spans.append(all_ if kind == "email" else F.filter(all_, checked(kind)))
    return F.array_sort(F.concat(*spans))


def before(text: Column, s: Column) -> Column:
    return F.lower(F.substr(text, F.greatest(s["start"] - 11, F.lit(1)), F.least(s["start"], F.lit(12))))


def cell(text: Column, s: Column) -> Column:
    """The cell of the features of a span; a contact word, by which phones are labelled, is no feature of them."""
    body, d, words = s["body"], digits(s["body"]), before(text, s)
    beside = F.concat(F.substr(text, s["start"], F.when(s["start"] > 0, 1).otherwise(0)), F.substr(text, s["end"] + 1, F.lit(1)))
    n = F.when(s["kind"] == 0, F.size(F.split(body, r"\."))).otherwise(F.length(d) - 8)
    groups = F.size(F.split(body, "[^0-9A-Za-z]+"))
    marks = F.length(F.regexp_replace(body, "[^() ]", ""))
    word = F.when(words.rlike(RECORD), 2).when((s["kind"] != 3) & words.rlike(CONTACT), 1).otherwise(0)
    parts = [s["kind"], F.greatest(F.lit(0), F.least(F.floor(n / 2), F.lit(5))), F.least(marks, F.lit(3)), F.greatest(F.lit(0), F.least(groups - 1, F.lit(3))),
             beside.rlike("[A-Za-z]").cast("int"), word, ((s["kind"] != 0) & F.startswith(d, F.lit("0"))).cast("int")]
    code = F.lit(0)
    for size, part in zip(SIZES, parts):
        code = code * size + part
    return code.cast("int")


def proved(text: Column, s: Column) -> Column:
    """The check of a candidate that no feature holds."""
    flat = F.regexp_replace(s["body"], ":", ".")
    return (F.when(s["kind"] == 0, s["body"].rlike(TOP)).when(s["kind"] == 1, (F.size(F.split(flat, r"\.")) == 4) & valid("ip", flat))
            .when(s["kind"] == 2, valid("card", s["body"])).otherwise(valid("phone", s["body"]) & before(text, s).rlike(PHONE)))


def loosened(s: Column) -> Column:
    """A base span in a form that the base patterns do not know."""
    body = s["body"]
    email = F.regexp_replace(F.regexp_replace(body, "@", " (at) "), r"\.(?=[^.]*$)", " (dot) ")
    card = F.regexp_replace(F.regexp_replace(body, "[ -]", ""), "([0-9]{4})(?=[0-9])", "$1.")
    loose = F.when(s["kind"] == 0, email).when(s["kind"] == 1, F.regexp_replace(body, r"\.", ":")).when(s["kind"] == 2, card).otherwise(F.regexp_replace(body, r"\+", ""))
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), loose.alias("body"))


def candidates(text: Column) -> Column:
    """Looser spans of every kind with the cell of their features and whether they are proved."""
    every = F.concat(*[found(text, LOOSE[kind], NEED[kind], k) for k, kind in enumerate(KINDS)])
    return F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), cell(text, s).alias("cell"),
                                                 proved(text, s).cast("int").alias("y")))


def overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def cells() -> np.ndarray:
    """Feature classes of every cell."""
    return np.stack(np.unravel_index(np.arange(CELLS), SIZES), 1)


def boost(counts: np.ndarray, rounds: int = 40, rate: float = 0.3) -> np.ndarray:
    """Gradient-boosted trees of two splits on counts per cell (columns: negatives, positives); log odds of every cell."""
    x, n, pos = cells(), counts.sum(1), counts[:, 1]
    splits = [(f, v) for f, size in enumerate(SIZES) for v in range(size - 1)]
    odds = np.zeros(CELLS)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        grad, hess = pos - n * p, n * p * (1 - p)

        def leaf(rows):
            return grad[rows].sum() / (hess[rows].sum() + 1), grad[rows].sum() ** 2 / (hess[rows].sum() + 1)

        def best(rows):
            gains = [(sum(leaf(rows & side)[1] for side in (x[:, f] <= v, x[:, f] > v)), f, v) for f, v in splits]
            return max(gains)

        _, f, v = best(np.ones(CELLS, bool))
        for side in (x[:, f] <= v, x[:, f] > v):
            _, g, u = best(side)
            for part in (side & (x[:, g] <= u), side & (x[:, g] > u)):
                odds[part] += rate * leaf(part)[0]
    return odds


def calibrated(train: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Probability of each cell where it is selected, else 0: for each kind the lowest threshold whose selections in the held-out
    counts have the precision asked for; cells that were never held out, or are likelier wrong than right, are not selected."""
    odds, kind = boost(train), cells()[:, 0]
    out = np.zeros(CELLS)
    for k in range(len(KINDS)):
        order = np.argsort(-odds, kind="stable")
        order = order[(held.sum(1)[order] > 0) & (kind[order] == k) & (odds[order] > 0)]
        total, hits = np.cumsum(held.sum(1)[order]), np.cumsum(held[order, 1])
        ends = np.r_[odds[order][1:] < odds[order][:-1], True][:len(order)]  # cells of equal odds together
        good = np.flatnonzero((hits >= PRECISION * total) & (total >= LEAST) & ends)
        if len(good):
            chosen = order[:good[-1] + 1]
            out[chosen] = 1 / (1 + np.exp(-odds[chosen]))
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base (spans), added (spans that the boosted trees select)."""
    text = whole()
    both = docs.select("doc_id", let(text, lambda t: let(base_spans(t), lambda base: F.struct(
        base.alias("base"), candidates(t).alias("loose"), F.transform(base, lambda s: cell(t, loosened(s))).alias("rewritten")))).alias("s"))
    free = lambda c: ~F.exists(F.col("s.base"), lambda b: overlap(b, c))
    fold = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)), F.lit(0))
    outside = F.transform(F.filter(F.col("s.loose"), free), lambda c: F.struct(fold.alias("fold"), c["cell"].alias("cell"), F.coalesce(c["y"], F.lit(0)).alias("y")))
    known = F.when(fold == 0, F.transform(F.col("s.rewritten"), lambda c: F.struct(fold.alias("fold"), c.alias("cell"), F.lit(1).alias("y"))))
    seen = (both.select(F.explode(F.concat(outside, F.coalesce(known, F.array().cast("array<struct<fold:bigint,cell:int,y:int>>")))).alias("c"))
            .groupBy("c.fold", "c.cell", "c.y").count().collect())  # at most 4 * CELLS rows
    counts = np.zeros((2, CELLS, 2))
    for r in seen:
        counts[r["fold"], r["cell"], r["y"]] += r["count"]
    chance = calibrated(counts[0], counts[1]).tolist()
    literal = docs.sparkSession.createDataFrame([(chance,)], "chance array<double>")
    scored = both.select("doc_id", "s", scalar(literal).alias("_chance"))

    def select(chance: Column) -> Column:
        rated = F.filter(F.transform(F.col("s.loose"), lambda c: F.struct(F.get(chance, c["cell"]).alias("p"), (-c["kind"]).alias("order"), c["start"].alias("start"),
                                                                          c["end"].alias("end"), c["kind"].alias("kind"))),
                         lambda c: (c["p"] > 0) & ~F.exists(F.col("s.base"), lambda b: overlap(b, c)))
        return let(rated, lambda r: F.filter(r, lambda c: ~F.exists(r, lambda o: overlap(o, c) & (F.struct(o["p"], o["order"]) > F.struct(c["p"], c["order"])))))

    slim = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    return scored.select("doc_id", F.transform(F.col("s.base"), slim).alias("base"), F.transform(let(F.col("_chance"), select), slim).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    names = F.array(*map(F.lit, KINDS))
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def number(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

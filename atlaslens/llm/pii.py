"""Personal data: generators with high recall, boosted trees over the candidates, redaction.

Only column expressions touch the texts. Strict generators follow the base
rules; loose ones propose written-around forms, and spans may overlap. Each
candidate is a mask of yes/no features of its format and context. Trees are
boosted on the counts of all masks in the corpus (at most 2**14 numbers), with
the check sums and ranges of the strict forms as labels, and become a column
expression again. The check itself is the label, so no tree may split on it.
Candidates that pass the base rules always stay; of the others those are added
that do not fail their own check and lie above a threshold, which is calibrated
on masks that the trees giving their scores were not fitted on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from atlaslens.llm.common import as_row, columns_of, stage

KINDS = ("email", "ip", "card", "phone")
FEATURES = (
    "email", "ip", "card", "phone", "check", "plain", "spaced", "odd_signs", "marked", "keyword",
    "glued_left", "glued_right", "many_digits", "few_digits",
)
CHECK = 1 << FEATURES.index("check")
SPLITS = [f for f, name in enumerate(FEATURES) if name != "check"]  # what trees may split on
TREES, RATE, PRECISION, FOLDS = 24, 0.3, 0.98, 5

# The base rules. Greedy loops that nothing follows are possessive, and a match may start inside a
# run only where the last one ended; both leave the matches as they are and the time linear.
_LOCAL, _HOST = "A-Za-z0-9._%+-", "[A-Za-z0-9-]"
STRICT = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Written-around forms. Names of words are lower or upper case.
LOOSE = {
    "email": rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}\x20?(?:\(at\)|\[at\]|\{{at\}})\x20?{_HOST}{{1,63}}(?:\x20?(?:\(dot\)|\[dot\]|\{{dot\}}|\.)\x20?{_HOST}{{1,63}}){{1,6}}",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){2}[._/][0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.])(?:\([0-9]{2,4}\)|[0-9]{3,4})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# What a text must hold for a generator to be worth running on it.
NEEDS = {
    ("email", True): "@", ("phone", True): r"\+[0-9]", ("ip", True): r"[0-9]\.[0-9]", ("card", True): r"[0-9][\x20-]?[0-9]",
    ("email", False): r"(?i)[(\[{]at[)\]}]", ("ip", False): r"(?i)[0-9]\x20?[(\[](?:\.|dot)[)\]]",
    ("card", False): r"[0-9]{4}[._/][0-9]{4}", ("phone", False): r"[0-9]{3}[\x20.-][0-9]{4}",
}
KEYWORDS = r"(?i)(mail|phone|tel\b|call|fax|mobile|contact|card|visa|account|\bip\b|host|server|address)"


def _check(kind: str, match: Column, digits: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0)), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(9, 15)


def _found(text: Column, kind: str, strict: bool) -> Column:
    """Array of (kind, start, end, strict, mask) of one generator; positions in code points, end exclusive."""
    pattern = F.lit((STRICT if strict else LOOSE)[kind])
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    number = KINDS.index(kind)

    def describe(match: Column, before: Column, after: Column) -> Column:
        digits = F.regexp_replace(match, "[^0-9]", "")
        last, first = F.substring(before, -1, 1), F.substring(after, 1, 1)
        flags = {
            kind: F.lit(True), "check": _check(kind, match, digits),
            "plain": match.rlike("^[0-9]+$"), "spaced": match.rlike(r"[\x20-]"), "odd_signs": match.rlike(r"[()\[\]{}_/]"),
            "marked": match.rlike(r"[@+]"), "keyword": F.substring(before, -24, 24).rlike(KEYWORDS),
            "glued_left": last.rlike("[A-Za-z0-9]"), "glued_right": first.rlike("[A-Za-z0-9]"),
            "many_digits": F.length(digits) >= 13, "few_digits": F.length(digits) <= 10,
        }
        mask = F.lit(0)
        for name, flag in flags.items():
            mask = mask + F.when(flag, 1 << FEATURES.index(name)).otherwise(0)
        return mask.cast("int")

    # Positions are running sums of gap and match lengths.
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("g"), matches.alias("m"), F.slice(gaps, 2, F.size(matches)).alias("a"))
    empty = F.expr("cast(array() as array<struct<kind:int,start:int,end:int,strict:boolean,mask:int>>)")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["g"])
        end = (start + F.length(pair["m"])).cast("int")
        one = F.struct(
            F.lit(number).alias("kind"), start.cast("int").alias("start"), end.alias("end"),
            F.lit(strict).alias("strict"), describe(pair["m"], pair["g"], pair["a"]).alias("mask"),
        )
        # Digit runs that are too short or long to be anything would swell the list for nothing.
        worth = F.length(F.regexp_replace(pair["m"], "[^0-9]", "")).between(13, 19) if kind == "card" else F.lit(True)
        return F.struct(end.alias("at"), F.when(worth, F.concat(state["out"], F.array(one))).otherwise(state["out"]).alias("out"))

    folded = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])
    return F.when(text.rlike(NEEDS[kind, strict]), folded).otherwise(empty)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``candidates`` to documents; a null text has none."""
    text = F.coalesce(F.col(text), F.lit(""))
    arrays = [_found(text, kind, strict) for strict in (True, False) for kind in KINDS]
    return docs.withColumn("candidates", F.concat(*arrays))


@dataclass
class Model:
    bias: float
    trees: list[tuple]  # (feature, (feature, no, yes), (feature, no, yes)): first the branch where the feature is off
    threshold: float

    def margin(self, mask: Column) -> Column:
        on = lambda f: mask.bitwiseAND(F.lit(1 << f)) != 0
        total = F.lit(self.bias)
        for top, off, yes in self.trees:
            leaf = lambda b: F.when(on(b[0]), b[2]).otherwise(b[1])
            total = total + F.when(on(top), leaf(yes)).otherwise(leaf(off))
        return total

    def probability(self, mask: Column) -> Column:
        return 1 / (1 + F.exp(-self.margin(mask)))

    def scores(self, masks: np.ndarray) -> np.ndarray:
        """The same for an array of masks."""
        on = lambda f: (masks >> f) & 1 == 1
        total = np.full(len(masks), self.bias)
        for top, off, yes in self.trees:
            total += np.where(on(top), *(np.where(on(f), b, a) for f, a, b in (yes, off)))
        return 1 / (1 + np.exp(-total))


def _threshold(p: np.ndarray, good: np.ndarray, total: np.ndarray) -> float:
    """The lowest score from which on upwards enough candidates are good; no score reaches it if there is none."""
    scores, at = np.unique(-p, return_inverse=True)  # equal scores stand or fall together
    precision = np.cumsum(np.bincount(at, good)) / np.maximum(np.cumsum(np.bincount(at, total)), 1)
    above = -scores[precision >= PRECISION]
    return max(0.5, float(above.min())) if len(above) else 1.1


def calibrate(masks: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The threshold on scores that every mask gets from trees fitted on the other folds' masks.

    Loose forms make masks that no strict form has, so what counts is how the
    trees judge masks they have not seen.
    """
    kinds, at = np.unique(masks & ~CHECK, return_inverse=True)
    weight = np.bincount(at, good + bad)
    fold = np.empty(len(kinds), np.int64)
    fold[np.lexsort((kinds, -weight))] = np.arange(len(kinds)) % FOLDS
    p = np.zeros(len(masks))
    for k in range(FOLDS):
        held = fold[at] == k
        model = fit(masks[~held], good[~held], bad[~held])
        if model is not None:
            p[held] = model.scores(masks[held])
        elif good[~held].sum():  # the others are all good
            p[held] = 1.0
    return _threshold(p, good, good + bad)


def fit(masks: np.ndarray, good: np.ndarray, bad: np.ndarray) -> Model | None:
    """Boosts trees of two levels on counts per mask; None without examples of both kinds.

    The threshold is that of the given masks; ``calibrate`` has the one of masks not seen.
    """
    total = good + bad
    if not good.sum() or not bad.sum():
        return None
    bits = (masks[:, None] >> np.arange(len(FEATURES))) & 1 == 1
    bias = float(np.log(good.sum() / bad.sum()))
    margin = np.full(len(masks), bias)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = good - total * p, total * p * (1 - p)

        def best(rows: np.ndarray) -> tuple[float, tuple]:
            """The split of some rows that gains most, with the values of both sides."""
            found = (-1.0, (0, 0.0, 0.0))
            for f in SPLITS:
                sides = [(gradient[rows & side].sum(), hessian[rows & side].sum() + 1.0) for side in (~bits[:, f], bits[:, f])]
                gain = sum(g * g / h for g, h in sides)
                if gain > found[0] + 1e-9:
                    found = (gain, (f, *(float(RATE * g / h) for g, h in sides)))
            return found

        options = []
        for f in SPLITS:
            off, on = best(~bits[:, f]), best(bits[:, f])
            options.append((off[0] + on[0], -f, (f, off[1], on[1])))
        _, _, tree = max(options)
        trees.append(tree)
        top, off, on = tree
        for side, (f, no, yes) in ((~bits[:, top], off), (bits[:, top], on)):
            margin += side * np.where(bits[:, f], yes, no)
    return Model(bias, trees, _threshold(1 / (1 + np.exp(-margin)), good, total))


def train(found: DataFrame) -> Model | None:
    """From the candidates of all documents: strict ones that pass their check against those that fail it."""
    each = found.select(F.explode("candidates").alias("c")).where("c.strict")
    passed = F.col("c.mask").bitwiseAND(F.lit(CHECK)) != 0
    rows = each.groupBy(F.col("c.mask").alias("mask")).agg(
        F.sum(passed.cast("long")).alias("good"), F.sum((~passed).cast("long")).alias("bad")
    ).collect()
    columns = [np.array([r[c] for r in rows], dtype=np.int64) for c in ("mask", "good", "bad")]
    model = fit(*columns)
    if model is not None:
        model.threshold = calibrate(*columns)
    return model


def select(found: DataFrame, model: Model | None) -> DataFrame:
    """Replaces ``candidates`` by ``base`` and ``spans``: arrays of (kind, start, end) by kind as listed, then start.

    ``spans`` has all of ``base`` and those others that the trees accept, whose
    own check does not say that they are none, and that do not overlap a base span.
    """
    passed = lambda c: c["mask"].bitwiseAND(F.lit(CHECK)) != 0
    plain = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    base = F.array_sort(F.transform(F.filter("candidates", lambda c: c["strict"] & passed(c)), plain))
    with_base = found.withColumn("base", base)
    if model is None:
        return with_base.withColumn("spans", F.col("base")).drop("candidates")
    apart = lambda c: F.forall("base", lambda b: (b["end"] <= c["start"]) | (c["end"] <= b["start"]))
    wanted = F.filter("candidates", lambda c: ~c["strict"] & passed(c) & (model.probability(c["mask"]) >= model.threshold) & apart(c))
    return with_base.withColumn("spans", F.array_sort(F.concat("base", F.transform(wanted, plain)))).drop("candidates")


def listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans of every document. Repeated rows are found again; empty tables give no rows."""
    found = stage(candidates(docs.select("doc_id", "text")).drop("text"), "pii")
    return select(found, train(found))


def redact(docs: DataFrame) -> DataFrame:
    """Documents with every span replaced by its kind in brackets; columns as they were.

    Overlapping spans become one, named after the first. Null texts stay null.
    ``n_chars``, if there, is the length of the new text.
    """
    # Rows travel as one column, so that no name of theirs meets one of these.
    found = stage(candidates(docs.select(as_row(docs).alias("row")), "row.text"), "pii-texts")
    chosen = select(found, train(found))
    text = F.col("row.text")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.when(s["start"] >= state["at"], F.struct(
            s["end"].alias("at"), F.concat(state["out"], gap, names[s["kind"]]).alias("out")
        )).otherwise(F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out")))

    folded = F.aggregate(by_start, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    rest = text.substr(F.col("cut.at") + 1, F.length(text))
    changed = chosen.withColumn("cut", F.when(F.size("spans") > 0, folded)).withColumn(
        "new", F.when(F.col("cut").isNotNull(), F.concat(F.col("cut.out"), rest)).otherwise(text)
    )
    columns = columns_of(docs, "row.") | {"text": F.col("new")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("cut").isNotNull(), F.length("new").cast(kind)).otherwise(columns["n_chars"])
    return changed.select(*(column.alias(name) for name, column in columns.items()))

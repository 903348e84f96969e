"""Personal data by candidate spans and boosted trees, with DataFrame functions only.

Base spans are exact: four patterns (email, ip, card, phone), leftmost and not overlapping within a kind, kept when
they pass their check. Positions come from the lengths of the matches and of the text between them, so a text is
scanned once for its matches and, only if there are any, once more for the gaps. The patterns are written with
possessive groups and anchored starts: they match what the plain patterns match, need no recursion, and take time
in proportion to the text.

Looser generators propose further, overlapping spans (spelled-out or international addresses, dotted numbers, long
digit runs, phone numbers without a plus). Gradient-boosted trees score every proposal by its format (digits,
groups, separators, ends) and context (the characters around it, words that announce personal data). They learn from
a bounded sample of documents. Positive are proposals that are a checked base span, and those of base spans rewritten where
they stand to the loose forms (``loose_forms``), which no table labels; a rewritten one counts ``LOOSE_WEIGHT``. Negative are
proposals that fail the check of their kind, and phone numbers that no word announces. Others, which may well be personal
data, teach nothing. The checks themselves (Luhn, the range of parts) are no features, so proposals that look and stand
like checked ones score high. Per kind the threshold is the lowest score at which the positives make ``PRECISION`` of the
proposals of all documents the trees have not learned from, and ``OWN_PRECISION`` of those with that very score. Proposals
above it are added where they overlap no earlier proposal and no base span but those of their kind that they contain. The
trees become one SQL expression.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.arrays import largest, least, let, scan, shifted, total
from starmart.llm.common import in_sample, table, written

KINDS = ("email", "ip", "card", "phone")
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "email": (r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++ ?(?:@|\((?i:at)\)|\[(?i:at)\]) ?[\p{L}0-9-]++"
              r"(?:(?:\.| ?\((?i:dot)\) ?| ?\[(?i:dot)\] ?)[\p{L}0-9-]++)++"),
    "ip": r"(?<![0-9])[0-9]++(?: ?\. ?[0-9]++){3}+",
    "card": r"[0-9](?:[\x20./\xA0-]?[0-9]){11,}+",
    "phone": r"(?:\+|\(|(?<![0-9]))[0-9][\x20()./0-9-]{5,}[0-9]",
}
HINTS = r"(?i)(mail|phone|call|tel|mobile|fax|contact|card|visa|pay|account|iban|address|host|server|login|user)"
CONTEXT_CHARS = 24
AT, DOT = r" ?(?:@|\((?i:at)\)|\[(?i:at)\]) ?", r" ?(?:\.|\((?i:dot)\)|\[(?i:dot)\]) ?"
LOOSE_WEIGHT = 0.1  # of a rewritten base span, against 1 of a proposal that is there
SAMPLE_DOCS = 20_000
TREES, DEPTH, STEP = 20, 3, 0.3
PRECISION, OWN_PRECISION = 0.98, 0.9
LEAST_PROPOSALS = 20  # held-out proposals of a kind needed to set its threshold
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
FEATURES = (*(f"is_{k}" for k in KINDS), "digits", "groups", "length", "plus", "at_sign", "spelled", "first_space",
            "before", "after", "hint")


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes the Luhn check."""
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, -i, 1).cast("int")
        return acc + F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"\A{IP_PART}(?:\.{IP_PART}){{3}}\z")
    digits = F.regexp_replace(match, "[^0-9]", "")
    low, high = (14, 19) if kind == "card" else (10, 15)
    good = F.length(digits).between(low, high)
    return good & let(digits, lambda d: F.when(F.length(d).between(low, high), luhn(d)).otherwise(F.lit(False))) \
        if kind == "card" else good


def found(text: Column, pattern: str, gate: Column) -> Column:
    """All matches as ``array<struct<start, end, match>>`` (code points, end exclusive); none where ``gate`` fails."""
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def placed(matches: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        lengths = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)),
                             lambda m, g: F.length(m) + F.length(g))
        return let(scan(lengths, total), lambda ends: F.transform(matches, lambda m, i: F.struct(
            (ends[i] - F.length(m)).alias("start"), ends[i].alias("end"), m.alias("match"))))

    return F.when(gate, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                            lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none))).otherwise(none)


def gates(text: Column, digit: Column) -> dict[str, Column]:
    return {"email": text.contains("@"), "ip": digit, "card": digit, "phone": digit & text.contains("+")}


def with_base(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep``, ``pii_text`` (NULL as empty) and ``base``: checked spans by start and kind."""
    df = docs.select(*keep, F.coalesce("text", F.lit("")).alias("pii_text"))
    df = df.select("*", F.col("pii_text").rlike("[0-9]").alias("pii_digit"))
    text, digit = F.col("pii_text"), F.col("pii_digit")

    def checked(k: int, kind: str) -> Column:
        return F.transform(F.filter(found(text, BASE[kind], gates(text, digit)[kind]),
                                    lambda s: passes(kind, s["match"])),
                           lambda s: F.struct(s["start"], F.lit(k).alias("kind"), s["end"]))

    spans = [checked(k, kind) for k, kind in enumerate(KINDS)]
    return df.select("*", F.array_sort(F.concat(*spans)).alias("base"))


def loosely_passes(kind: str, match: Column) -> Column:
    """Whether a proposal passes the check of its kind once its separators are those of a base span."""
    if kind == "email":
        return match.rlike(rf"{DOT}\p{{L}}{{2,}}\z")
    if kind == "ip":
        return passes(kind, F.regexp_replace(match, " ", ""))
    return passes(kind, match)


def loose_forms(kind: Column, match: Column) -> Column:
    """The loose forms of a base span: spelled-out and spaced addresses, spaced parts, dotted numbers, phone numbers
    without plus and without country."""
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)

    def email(at: str, dot: str) -> Column:
        return F.concat(local, F.lit(at), F.replace(domain, F.lit("."), F.lit(dot)))

    digits = F.regexp_replace(match, "[^0-9]", "")
    forms = [F.array(email(" (at) ", " (dot) "), email("[at]", "[dot]"), email("(at)", "."), email(" @ ", ".")),
             F.array(F.replace(match, F.lit("."), F.lit(" . "))),
             F.array(*(F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{gap}") for gap in (".", "\u00a0"))),
             F.array(F.regexp_replace(match, r"\A\+", ""), F.regexp_replace(match, r"\A\+[0-9]{1,3}[ .-]*+(?=[(0-9])", ""))]
    return F.array(*forms)[kind]


def rewritten(text: Column, base: Column) -> Column:
    """Base spans in loose forms with the text around them: ``array<struct<kind, start, end, text>>``."""
    def windows(s: Column) -> Column:
        width = F.greatest(s["start"] - 2 * CONTEXT_CHARS, F.lit(0))
        before = F.substring(text, width + 1, s["start"] - width)
        match = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        after = F.substring(text, s["end"] + 1, F.lit(CONTEXT_CHARS))
        return F.transform(loose_forms(s["kind"], match), lambda f: F.struct(
            s["kind"].alias("kind"), F.length(before).alias("start"), (F.length(before) + F.length(f)).alias("end"),
            F.concat(before, f, after).alias("text")))

    return F.flatten(F.transform(base, windows))


def proposals(text: Column, digit: Column, checked: bool = False) -> Column:
    """``array<struct<start, kind, end, features...>>`` of the generators; features are small whole numbers.

    ``checked`` adds ``ok``: whether the proposal passes ``loosely_passes``."""
    at = text.contains("@") | text.contains("(") | text.contains("[")

    def of_kind(k: int, kind: str) -> Column:
        def features(s: Column) -> Column:
            match = s["match"]
            width = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
            before = F.substring(text, width + 1, s["start"] - width)
            after = F.substring(text, s["end"] + 1, F.lit(1))
            digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
            edge = F.substring(before, -1, 1)

            def side(c: Column) -> Column:
                return (F.when(c == "", F.lit(0)).when(c.rlike(r"\s"), F.lit(1)).when(c.rlike(r"[.,;:!?)\"']"), F.lit(2))
                        .when(c.rlike(r"[\p{L}_]"), F.lit(3)).when(c.rlike("[0-9]"), F.lit(4)).otherwise(F.lit(5)))

            values = [*(F.lit(int(k == j)) for j in range(len(KINDS))), F.least(digits, F.lit(25)),
                      F.least(F.size(F.split(match, "[^0-9]+")), F.lit(8)), F.least(F.length(match), F.lit(40)),
                      F.substring(match, 1, 1).eqNullSafe(F.lit("+")).cast("int"), match.contains("@").cast("int"),
                      match.rlike(r"(?i)[(\[](at|dot)[)\]]").cast("int"), match.contains(" ").cast("int"), side(edge),
                      side(after), before.rlike(HINTS).cast("int")]
            ok = [loosely_passes(kind, match).alias("ok")] if checked else []
            return F.struct(s["start"], F.lit(k).alias("kind"), s["end"], *ok,
                            *(v.cast("int").alias(name) for v, name in zip(values, FEATURES)))

        return F.transform(found(text, PROPOSED[kind], at if kind == "email" else digit), features)

    return F.concat(*(of_kind(k, kind) for k, kind in enumerate(KINDS)))


def tree_expression(lines: list[str], row) -> Column:
    """The SQL expression of a regression tree from its printed form."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return F.lit(float(line.split(":")[1]))
    feature, value = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    yes = tree_expression(lines, row)
    lines.pop(0)  # Else
    return F.when(row[FEATURES[int(feature)]] <= float(value), yes).otherwise(tree_expression(lines, row))


class Model:
    """Boosted trees as an expression, and the score each kind must reach."""

    def __init__(self, trees: list[tuple[float, str]], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, row) -> Column:
        raw = F.lit(0.0)
        for weight, printed in self.trees:
            raw = raw + F.lit(weight) * tree_expression(printed.strip().split("\n")[1:], row)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * raw))

    def selects(self, row) -> Column:
        chosen = F.lit(False)
        for kind, threshold in self.thresholds.items():
            chosen = chosen | ((row["kind"] == kind) & (F.lit(threshold) <= self.score(row)))
        return chosen


def labelled_cells(docs: DataFrame, name: str) -> DataFrame:
    """Proposals of the documents (``doc_id, text``) and of their rewritten base spans, counted by features and label: a
    small table."""
    df = with_base(docs, []).select("base", proposals(F.col("pii_text"), F.col("pii_digit"), True).alias("proposed"),
                                    rewritten(F.col("pii_text"), F.col("base")).alias("rewritten"))
    # the arrays are written, so that no later step computes them again
    df = written(docs.sparkSession, df, name)
    there = df.select("base", F.explode("proposed").alias("p"))
    is_base = F.array_contains("base", F.struct(F.col("p.start"), F.col("p.kind"), F.col("p.end")))
    unannounced = (F.col("p.kind") == KINDS.index("phone")) & (F.col("p.hint") == 0)
    there = there.select("p", F.when(is_base, 1).when(~F.col("p.ok") | unannounced, 0).alias("label"), F.lit(1.0).alias("weight"))
    loose = df.select(F.explode("rewritten").alias("r")).select(
        "r", F.explode(proposals(F.col("r.text"), F.lit(True), True)).alias("p"))
    same = [F.col(f"p.{c}") == F.col(f"r.{c}") for c in ("start", "kind", "end")]
    loose = loose.where(same[0] & same[1] & same[2]).select("p", F.lit(1).alias("label"), F.lit(LOOSE_WEIGHT).alias("weight"))
    return (there.where(F.col("label").isNotNull()).unionByName(loose)
            .select("label", "weight", "p.kind", *(F.col(f"p.{f}") for f in FEATURES))
            .groupBy("label", "weight", "kind", *FEATURES).agg((F.count(F.lit(1)) * F.col("weight")).alias("n")))


def fit(docs: DataFrame) -> Model:
    """Boosted trees and thresholds; without positive and negative proposals nothing is ever added.

    The trees learn from 3 in 4 rows of the sample; the thresholds come from all other rows of ``docs``.
    """
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    count = rows.count()
    part = F.pmod(F.xxhash64(F.lit("part"), "text"), F.lit(4)) > 0
    train = part & in_sample(F.col("text"), SAMPLE_DOCS, count)
    cells = written(docs.sparkSession, labelled_cells(rows.where(train), "pii-proposals").coalesce(1), "pii-cells")
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(cells)
    classes = {r["label"] for r in data.select("label").distinct().collect()}
    if classes != {0, 1}:
        return Model([], {})
    gbt = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH,
                        stepSize=STEP, seed=7, minInstancesPerNode=1)
    fitted = gbt.fit(data)
    model = Model([(w, t.toDebugString) for w, t in zip(fitted.treeWeights, fitted.trees)], {})
    scores = (labelled_cells(rows.where(~train), "pii-proposals-held-out")
              .select("kind", "label", "n", model.score({f: F.col(f) for f in FEATURES}).alias("score"))
              .groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("hits"))
              .collect())
    for kind in range(len(KINDS)):
        n = hits = 0.0
        for r in sorted((r for r in scores if r["kind"] == kind), key=lambda r: -r["score"]):
            n, hits = n + r["n"], hits + r["hits"]
            sure = hits >= PRECISION * n and r["hits"] >= OWN_PRECISION * r["n"]
            if n >= LEAST_PROPOSALS and sure and not math.isnan(r["score"]):
                model.thresholds[kind] = r["score"] - 1e-12
    return model


def without_overlaps(base: Column, extra: Column) -> Column:
    """The sorted base spans and those of ``extra`` that overlap no earlier proposal and no base span.

    An email proposal may contain base emails (``jörg.müller@firma.de`` contains ``ller@firma.de``); both stay."""
    email = KINDS.index("email")

    def chosen(both: Column) -> Column:
        # at a tie a proposal stands before the base span
        wide = F.transform(both, lambda s: F.when((s["extra"] == 1) & (s["kind"] == email), s["end"]))

        def marked(cover: Column) -> Column:
            """1 a proposal, 0 a base span, 2 a base email inside a proposed one."""
            return F.transform(both, lambda s, i: F.when(s["extra"] == 1, F.lit(1)).when(
                (s["kind"] == email) & F.coalesce(cover[i] >= s["end"], F.lit(False)), F.lit(2)).otherwise(F.lit(0)))

        def before(marks: Column, kept: Callable[[Column], Column]) -> Column:
            return shifted(scan(F.transform(both, lambda s, i: F.when(kept(marks[i]), s["end"])), largest), 1)

        def after(marks: Column, kept: Callable[[Column], Column]) -> Column:
            return shifted(scan(F.transform(both, lambda s, i: F.when(kept(marks[i]), s["start"])), least, -1), -1)

        def free(ends: Column, starts: Column) -> Callable[[Column, Column], Column]:
            return lambda s, i: (F.coalesce(ends[i], F.lit(0)) <= s["start"]) & F.coalesce(starts[i] >= s["end"], F.lit(True))

        def kept(marks: Column) -> Column:
            def same(s: Column, i: Column) -> Column:  # a proposal that is the base span itself
                following = F.get(both, i + 1)
                return F.coalesce((following["extra"] == 0) & (following["start"] == s["start"])
                                  & (following["kind"] == s["kind"]) & (following["end"] == s["end"]), F.lit(False))

            reaches = F.struct(before(marks, lambda m: m == 1).alias("ee"),
                               before(marks, lambda m: m != 1).alias("be"), after(marks, lambda m: m != 1).alias("bn"),
                               before(marks, lambda m: m == 0).alias("ue"), after(marks, lambda m: m == 0).alias("un"))
            return let(reaches, lambda r: F.filter(both, lambda s, i: (s["extra"] == 0) | (
                (F.coalesce(r["ee"][i], F.lit(0)) <= s["start"]) & ~same(s, i)
                & F.when(s["kind"] == email, free(r["ue"], r["un"])(s, i)).otherwise(free(r["be"], r["bn"])(s, i)))))

        return let(shifted(scan(wide, largest), 1), lambda cover: let(marked(cover), kept))

    def span(flag: int):
        return lambda s: F.struct(s["start"], s["kind"], F.lit(1 - flag).alias("later"), s["end"], F.lit(flag).alias("extra"))

    both = F.array_sort(F.concat(F.transform(base, span(0)), F.transform(extra, span(1))))
    return F.when(F.size(extra) == 0, base).otherwise(F.array_sort(
        F.transform(let(both, chosen), lambda s: F.struct(s["start"], s["kind"], s["end"]))))


def with_spans(docs: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """``with_base`` and ``all_spans``: base and added spans by start and kind."""
    df = with_base(docs, keep)
    if not model.thresholds:
        return df.select("*", F.col("base").alias("all_spans"))
    extra = F.transform(F.filter(proposals(F.col("pii_text"), F.col("pii_digit")), model.selects),
                        lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return (df.select("*", extra.alias("pii_extra"))
            .select("*", without_overlaps(F.col("base"), F.col("pii_extra")).alias("all_spans")).drop("pii_extra"))


def listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find_pii(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Spans of personal data in every whole text of ``docs`` (``doc_id, text``); no shuffle but for training.

    ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``: counts and digest of the base spans, and all
    spans as ``kind:start:end`` joined by commas. NULL texts are empty ones; a NULL ``doc_id`` stays NULL; repeated
    rows are reported again; extra columns are ignored; an empty table gives no rows.
    """
    df = with_spans(docs, ["doc_id"], model or fit(docs))

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return df.select(
        "doc_id", *map(count, range(len(KINDS))),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("all_spans")).alias("spans"))


BLOCK = 4096


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; spans overlapping an earlier one join it.

    The text is cut into blocks once, so the cost does not grow with text length times spans.
    """
    def build(blocks: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            first = F.floor(start / BLOCK).cast("int")
            last = F.floor((end - 1) / BLOCK).cast("int")
            parts = F.transform(F.slice(blocks, first + 1, last - first + 1), lambda b, j: F.substring(
                b, F.greatest(start - (first + j) * BLOCK, F.lit(0)) + 1,
                end - F.greatest(start, (first + j) * BLOCK)))
            return F.when(end > start, F.array_join(parts, "")).otherwise(F.lit(""))

        names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

        def done(reach: Column) -> Column:
            def one(s: Column, i: Column) -> Column:
                before = F.coalesce(F.get(reach, i - 1), F.lit(0))
                return F.when(s["start"] < before, F.lit("")).otherwise(
                    F.concat(piece(before, s["start"]), names[s["kind"]]))

            return F.concat(F.array_join(F.transform(spans, one), ""),
                            piece(reach[F.size(reach) - 1], F.length(text)))

        return let(scan(F.transform(spans, lambda s: s["end"]), largest), done)

    return F.when(F.size(spans) == 0, text).otherwise(
        let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), build))


def without_pii(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` (all columns) with every span in ``text`` replaced by its kind in brackets and ``n_chars``, where there
    is one, set to the new length. NULL texts stay NULL, a NULL ``doc_id`` stays, repeated rows are redacted alike, an empty
    table gives no rows."""
    columns = docs.columns
    packed = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in columns)).alias("pii_row"))
    df = with_spans(packed, ["pii_row"], model or fit(docs))
    clean = F.when(F.col("pii_row.text").isNotNull(), redacted(F.col("pii_text"), F.col("all_spans")))
    df = df.select("pii_row", clean.alias("pii_clean"))
    return df.select(*(
        F.col("pii_clean").alias("text") if c == "text" else
        F.length("pii_clean").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
        F.col(f"pii_row.`{c}`").alias(c) for c in columns))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))

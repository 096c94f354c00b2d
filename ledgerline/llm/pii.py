"""Personal data: fixed patterns, and boosted trees over the candidates of looser generators.

The base patterns (e-mail, IP address, card, phone) with their checks always count. Beside
them, high-recall generators propose spans, overlapping ones too: spelled-out e-mail
addresses, numbers with odd separators, phones without a plus. A candidate becomes a small
vector of format features (the kind's check, separators, digit count) and context features
(a cue word before it, what it touches). All documents' candidates are counted by vector,
which is a table of at most ``VECTORS`` rows; gradient boosted trees learn on these weighted
rows which vectors look like checked spans (those that equal a base span) and which like
failed ones (nothing of the base in them, and either the kind's check fails, or they are part
of a longer code, or there is neither a cue nor a telling form). On documents held out
from training, the lowest score that keeps the wanted precision is each kind's threshold.
Candidates that have neither label are added if their vector passes.

Everything runs as DataFrame functions: matches and the gaps between them give positions in
code points, within the row of the document. No text is shuffled.

Defined cases: a null or empty text has no spans; a null doc_id is kept; repeated rows are
treated one by one; without candidates of both labels the method adds nothing; an empty
table gives an empty result. Other columns are kept by ``redacted`` and left out by ``find``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import carried, materialise, restored

KINDS = ("email", "ip", "card", "phone")

# The patterns as they are defined, written so that Java needs linear time: a match can only
# begin where a run of its first characters begins (or where the last match ended), and
# loops don't give back what they took where that can't matter. A first look ahead skips other
# characters quickly.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]++)*+",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++(?:(?:\.|\[\.\])[0-9]++){3}+",
    "card": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9](?:[\x20.-]?[0-9]){11,}+",
    "phone": r"(?=[+(0-9])(?:\+|\()?[0-9][\x20().0-9-]{5,}[0-9]",
}
#: what a text must contain for a kind's patterns to be tried; looked up once per text
NUMBER = r"[0-9][\x20().\[\]0-9-]{5,}[0-9]"
NEEDS = {"email": "pii_at", "ip": "pii_digit", "card": "pii_digit", "phone": "pii_digit"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CUE = r"(?i)(?:mail|phone|call|tel|fax|mobile|contact|card|visa|account|address|host|\bip)\W*$"
CONTEXT_CHARS = 24

#: feature, number of values; the kind is the first
FEATURES = (("kind", 4), ("check", 2), ("plus", 2), ("separators", 2), ("spelled", 2), ("digits", 6),
            ("cue", 2), ("glued_before", 2), ("glued_after", 2))
VECTORS = reduce(lambda n, f: n * f[1], FEATURES, 1)
PRECISION = 0.98
TREES, DEPTH = 10, 4
#: one document in so many is held out from training and sets the thresholds
HELD_OUT = 4


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    n = F.length(digits)

    def doubled(i: Column) -> Column:
        d = digits.substr(i, F.lit(1)).try_cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0),
                        lambda acc, i: acc + F.coalesce(doubled(i), F.lit(0)))
    return (n > 0) & (total % 10 == 0)


def base_check(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(match)).between(16, 19) & luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def loose_check(kind: str, match: Column) -> Column:
    """The kind's check on a candidate, whatever its separators."""
    if kind == "email":
        return match.rlike(r"(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z][A-Za-z0-9-]+$")
    if kind == "ip":
        return base_check("ip", F.regexp_replace(match, r"\[\.\]", "."))
    if kind == "card":
        return F.length(_digits(match)).between(12, 19) & luhn(_digits(match))
    return base_check("phone", match)


SPAN = "array<struct<start:int,end:int,match:string,before:string,after:string>>"


def with_needs(docs: DataFrame) -> DataFrame:
    """``pii_text`` (never null) and whether it holds a number long enough for any pattern, or a sign of an address."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    signs = reduce(lambda a, b: a | b, [F.contains(text, F.lit(sign)) for sign in ("@", "[at]", "(at)")])
    return docs.withColumns({"pii_text": text, "pii_at": signs, "pii_digit": text.rlike(NUMBER)})


def with_located(docs: DataFrame, prefix: str, patterns: dict[str, str]) -> DataFrame:
    """``<prefix>_<kind>``: all matches with their place in code points, and the text that touches them.

    The pieces that a split leaves lie between the matches; adding up both gives the places.
    Each step is a projection of its own, so that no pattern is tried twice.
    """
    text = F.col("pii_text")
    matched = docs.withColumns({
        f"{prefix}_{k}_matches": F.when(F.col(NEEDS[k]), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(
            F.array().cast("array<string>")) for k, p in patterns.items()})
    parted = matched.withColumns({
        f"{prefix}_{k}_gaps": F.when(F.size(f"{prefix}_{k}_matches") > 0, F.split(text, p, -1)).otherwise(
            F.array().cast("array<string>")) for k, p in patterns.items()})

    def located(kind: str) -> Column:
        matches, gaps = F.col(f"{prefix}_{kind}_matches"), F.col(f"{prefix}_{kind}_gaps")
        both = F.arrays_zip(matches.alias("match"), F.slice(gaps, 1, F.size(matches)).alias("before"),
                            F.slice(gaps, 2, F.size(matches)).alias("after"))
        empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

        def add(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["before"])
            end = start + F.length(x["match"])
            span = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"),
                            F.right(x["before"], F.lit(CONTEXT_CHARS)).alias("before"), F.left(x["after"], F.lit(1)).alias("after"))
            return F.struct(end.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

        return F.when(F.size(matches) > 0, F.aggregate(both, empty, add, lambda acc: acc["spans"])).otherwise(F.array().cast(SPAN))

    return parted.withColumns({f"{prefix}_{k}": located(k) for k in patterns}).drop(
        *[f"{prefix}_{k}_{part}" for k in patterns for part in ("matches", "gaps")])


def spelled(match: Column) -> Column:
    """Written out, such as ``name [at] host [dot] com``."""
    return match.rlike(r"\[|\((?:at|dot)")


def glued_before(span: Column) -> Column:
    return span["before"].rlike(r"""[\p{L}\p{N}"'=/_]$""")


def glued_after(span: Column) -> Column:
    return span["after"].rlike(r"""^[\p{L}\p{N}"'=/_]""")


def failed(kind: str, span: Column) -> Column:
    """No personal data: the check fails, or it is part of a longer code, or nothing around or in it speaks for it."""
    match = span["match"]
    return (~loose_check(kind, match) | glued_before(span) | glued_after(span)
            | (~span["before"].rlike(CUE) & ~spelled(match)))


def vector_key(kind: str, span: Column) -> Column:
    """The candidate's features as one number, mixed radix in the order of ``FEATURES``."""
    match, digits = span["match"], F.length(_digits(span["match"]))
    bucket = F.when(digits == 0, 0).when(digits < 8, 1).when(digits < 12, 2).when(digits < 16, 3).when(digits < 20, 4).otherwise(5)
    values = [
        F.lit(KINDS.index(kind)), loose_check(kind, match).cast("int"), match.startswith("+").cast("int"),
        match.rlike(r"[\x20().-]").cast("int"), spelled(match).cast("int"), bucket,
        span["before"].rlike(CUE).cast("int"), glued_before(span).cast("int"), glued_after(span).cast("int")]
    key = F.lit(0)
    for value, (_, size) in zip(values, FEATURES, strict=True):
        key = key * size + F.coalesce(value, F.lit(0))
    return key


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with the array ``base_<kind>`` of each kind."""
    def checked(kind: str) -> Column:
        return F.filter(f"base_{kind}", lambda s: base_check(kind, s["match"]))

    return with_located(with_needs(docs), "base", BASE).withColumns({f"base_{k}": checked(k) for k in KINDS})


def with_candidates(docs: DataFrame) -> DataFrame:
    """Adds ``loose_<kind>`` to what ``with_spans`` gives: candidates with their vector and label (1, 0 or null)."""
    found = with_located(docs, "loose", LOOSE)

    def marked(kind: str) -> Column:
        def one(s: Column) -> Column:
            def overlaps(k: str) -> Column:
                return F.exists(f"base_{k}", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

            equal = F.exists(f"base_{kind}", lambda b: (b["start"] == s["start"]) & (b["end"] == s["end"]))
            touched = reduce(lambda a, b: a | b, [overlaps(k) for k in KINDS])
            label = F.when(equal, 1).when(~touched & failed(kind, s), 0)
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), vector_key(kind, s).alias("key"),
                            label.alias("label"), touched.alias("touched"))

        return F.transform(f"loose_{kind}", one)

    return found.withColumns({f"loose_{k}": marked(k) for k in KINDS})


def vector_counts(docs: DataFrame) -> DataFrame:
    """How often each vector occurs with each label, in training and held-out documents: a table of bounded size."""
    rows = with_candidates(with_spans(docs.select("doc_id", "text"))).select(
        (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(HELD_OUT)) == 0).alias("held_out"),
        F.explode(F.concat(*[f"loose_{k}" for k in KINDS])).alias("c"))
    return rows.groupBy("held_out", F.col("c.key").alias("key"), F.col("c.label").alias("label")).agg(
        F.count(F.lit(1)).cast("double").alias("n"))


def _unpacked(counts: DataFrame) -> DataFrame:
    out, rest = counts, F.col("key")
    for name, size in reversed(FEATURES):
        out = out.withColumn(name, (rest % size).cast("double"))
        rest = F.floor(rest / size)
    return VectorAssembler(inputCols=[n for n, _ in FEATURES], outputCol="vector").transform(out)


def selected_vectors(counts: DataFrame, precision: float = PRECISION) -> list[int]:
    """The vectors whose score reaches their kind's threshold; at most ``VECTORS``."""
    labelled = _unpacked(counts.filter("label is not null")).withColumn("label", F.col("label").cast("double"))
    training = labelled.filter("not held_out")
    if training.select("label").distinct().count() < 2:
        return []
    model = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(training)
    scored = model.transform(_unpacked(counts.select("key").distinct())).select(
        "key", F.floor(F.col("key") / (VECTORS // FEATURES[0][1])).alias("kind"),
        vector_to_array("probability").getItem(1).alias("score"))
    held_out = counts.filter("held_out and label is not null").groupBy("key").agg(
        F.sum(F.col("n") * F.col("label")).alias("right"), F.sum("n").alias("all"))
    from_top = W.partitionBy("kind").orderBy(F.desc("score")).rangeBetween(W.unboundedPreceding, 0)
    passing = scored.join(held_out, "key", "left").withColumn(
        "share", F.try_divide(F.sum(F.coalesce("right", F.lit(0.0))).over(from_top), F.sum(F.coalesce("all", F.lit(0.0))).over(from_top)))
    thresholds = passing.filter(F.col("share") >= precision).groupBy("kind").agg(F.min("score").alias("least"))
    return [r["key"] for r in scored.join(thresholds, "kind").filter("score >= least").select("key").collect()]


def train(docs: DataFrame) -> list[int]:
    return selected_vectors(materialise(vector_counts(docs), "pii_vectors"))


def with_added(docs: DataFrame, selected: list[int]) -> DataFrame:
    """``base_<kind>`` and ``all_<kind>`` for each kind: base spans, and with the added ones, by start."""
    kept = [*docs.columns, "pii_text", *[f"{p}_{k}" for p in ("base", "all") for k in KINDS]]
    based = with_spans(docs)
    if not selected:
        return based.withColumns({f"all_{k}": F.col(f"base_{k}") for k in KINDS}).select(
            *kept)
    keys = F.array(*[F.lit(k) for k in sorted(selected)])

    def places(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    def added(kind: str) -> Column:
        fits = F.filter(f"loose_{kind}", lambda s: ~s["touched"] & s["label"].isNull() & F.array_contains(keys, s["key"]))
        return F.array_sort(F.concat(places(F.col(f"base_{kind}")), places(fits)))

    return with_candidates(based).withColumns({f"all_{k}": added(k) for k in KINDS}).select(
        *kept)


def _listed(prefix: str) -> Column:
    def each(kind: str) -> Column:
        return F.transform(f"{prefix}_{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*[each(k) for k in KINDS]), ",")


def find(docs: DataFrame) -> DataFrame:
    """Per document the number of base spans of each kind, their digest, and all spans."""
    rows = with_added(docs.select("doc_id", "text"), train(docs))
    return rows.select("doc_id", *[F.size(f"base_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
                       F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("all").alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; ``n_chars`` follows."""
    rows = with_added(carried(docs, "doc_id", "text"), train(docs))

    def marks(kind: str) -> Column:
        mark = F.lit(f"[{kind.upper()}]")
        return F.transform(f"all_{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), mark.alias("mark")))

    spans = F.array_sort(F.concat(*[marks(k) for k in KINDS]))
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def replace(acc: Column, s: Column) -> Column:
        # a span that begins inside the last one only lengthens it
        kept = F.when(s["start"] >= acc["at"], F.concat(
            acc["out"], F.col("pii_text").substr(acc["at"] + 1, s["start"] - acc["at"]), s["mark"])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), kept.alias("out"))

    done = F.aggregate("pii_spans", empty, replace, lambda acc: F.concat(
        acc["out"], F.col("pii_text").substr(acc["at"] + 1, F.length("pii_text"))))
    text = F.when(F.size("pii_spans") > 0, done).otherwise(F.col("text"))
    changed = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return restored(rows.withColumn("pii_spans", spans), docs.columns, **changed)

"""Personal data: fixed forms, and identifiers that appear where those forms do.

The fixed forms (e-mail, IPv4, card, phone) are seeds, and so are long mixed words behind a label of
secrets (`token = "..."`). Words that hold a digit or an @ are instances. The patterns an instance
stands in are the one, two or three words on its left, the words on both sides, and the word on its
left with the shape of the instance. The graph of patterns and instances, counted over all documents,
is scored in turns: a pattern is as good as the share of its instances that are known personal data
of one kind, an instance is as good as its best accepted pattern. Instances that no fixed form
covers, but that stand in an accepted pattern, are found as well; of several patterns the most
confident names the kind.

Everything is a DataFrame expression. A pattern is accepted from three known instances on, at every
size of the corpus. The accepted patterns are a table, joined to the instances, so their number has no
bound; Spark splits a hot word.

Regexes never look back over a run of characters they have passed, so that long runs of digits or
letters cost no more than other text.

Defined results: null text is empty and has no spans. Repeated rows are judged each for itself.
Columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.sources.scratch import written

KINDS = ("email", "ip", "card", "phone")
# Kinds of spans: base ones, and secrets, which the method adds.
ALL_KINDS = (*KINDS, "secret")
_SECRET = len(KINDS)
# Labels that stand before a secret, and its form.
_LABELS = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api-key", "access_key", "private_key", "credential")
_LABELLED = rf"""(?:^|[^a-z0-9])(?:{"|".join(_LABELS)})["']?+ ?+[:=]++["']?+$"""
_SECRET_FORM = "^(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])[A-Za-z0-9+/_=.-]{16,}+$"
# Forms of the seeds. The lookbehinds only keep a run from being tried at each place.
_FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_WORD = r"[^\x20\x09-\x0D"
_INSTANCE = rf"(?:\G|(?<!{_WORD}]))(?:{_WORD}0-9@])*+[0-9@]{_WORD}]*+"
_NEEDS = {"email": "@", "phone": "+"}
CONFIDENCE = 0.8
SUPPORT = 3
TURNS = 3
# Matches of a text that are placed together.
_TOGETHER = 128
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_MATCHES = "array<struct<start:int,match:string,before:string,after:string>>"
_ROW, _GIVEN = "_private_row", "_private_given"
_INSTANCES = "array<struct<start:int,end:int,word:string,contexts:array<string>,secret:boolean>>"
_BLANKS = r"[\x20\x09-\x0D]++"
# One to three whole words, and the blanks after them, at the end of a text.
_LEFT = rf"(?<!{_WORD}])((?:{_WORD}]++{_BLANKS}){{1,3}})$"
_CLOSING = r""".,;:!?)"'>\]}#$%&*"""


def _matches(text: Column, pattern: str, needs: str | None) -> Column:
    """Array of (start, match, before, after): every match, the text between it and the one before, and
    the word that follows it unless that is a match."""
    split = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    after = F.transform(F.slice(split, 2, F.size(found)), lambda s: F.regexp_extract(s, rf"^{_BLANKS}({_WORD}]++)", 1))
    pairs = F.arrays_zip(found.alias("match"), F.slice(split, 1, F.size(found)).alias("before"), after.alias("after"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_MATCHES).alias("out"))

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.char_length(pair["before"])
        one = F.struct(start.alias("start"), *[pair[c].alias(c) for c in ("match", "before", "after")])
        return F.struct((start + F.char_length(pair["match"])).alias("at"), F.array_append(done["out"], one).alias("out"))

    def block_step(done: Column, block: Column) -> Column:
        inside = F.aggregate(block, F.struct(done["at"].alias("at"), begin["out"].alias("out")), step)
        # An array of one, so that the block is gone through once.
        joined = F.transform(F.array(inside), lambda i: F.struct(i["at"].alias("at"), F.concat(done["out"], i["out"]).alias("out")))
        return F.element_at(joined, 1)

    # Appending copies what is there, so matches are placed in blocks and blocks are joined.
    last = F.greatest(F.size(found) - 1, F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(last / _TOGETHER)), lambda b: F.slice(pairs, (b * _TOGETHER + 1).cast("int"), _TOGETHER))
    placed = F.aggregate(blocks, begin, block_step, lambda done: done["out"])
    none = F.array().cast(_MATCHES)
    some = text.contains(needs) if needs else text.rlike("[0-9@]")
    return F.when(some, placed).otherwise(none)


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.coalesce(part.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        return F.char_length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def _valid_spans(number: int, kind: str) -> Column:
    def span(m: Column) -> Column:
        end = (m["start"] + F.char_length(m["match"])).cast("int")
        return F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), end.alias("end"))

    return F.transform(F.filter(f"_{kind}", lambda m: _valid(kind, m["match"])), span).cast(_SPAN)


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long")


def extract(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `base` (start, number of the kind, end) in order, and `instances` outside and inside of them."""
    value = F.coalesce(F.col(text), F.lit(""))
    out = docs.drop("base", "instances")
    for kind, pattern in _FORMS.items():
        out = out.withColumn(f"_{kind}", _matches(value, pattern, _NEEDS.get(kind)))
    spans = [_valid_spans(number, kind) for number, kind in enumerate(KINDS)]
    out = out.withColumn("base", F.array_sort(F.concat(*spans))).drop(*[f"_{kind}" for kind in KINDS])

    def instance(m: Column) -> Column:
        # Brackets, quotes and stops around a word are no part of it, nor is a label joined to it.
        bare = F.regexp_replace(m["match"], r"""^[("'<\[{]++""", "")
        label = F.regexp_extract(bare, r"""^([A-Za-z_][A-Za-z0-9_.-]*+["']?+[:=]++)["']?+[^"']""", 1)
        bare = F.regexp_replace(F.substring(bare, F.char_length(label) + 1, F.char_length(bare)), r"""^["']++""", "")
        start = m["start"] + F.char_length(m["match"]) - F.char_length(bare)
        bare = F.regexp_replace(bare, rf"(?<![{_CLOSING}])[{_CLOSING}]++$", "")
        words = F.split(F.trim(F.regexp_replace(F.concat(F.regexp_extract(m["before"], _LEFT, 1), label), _BLANKS, " ")), " ")
        return F.struct(
            start.alias("start"), (start + F.char_length(bare)).alias("end"), bare.alias("word"),
            F.transform(words, F.lower).alias("left"), F.lower(m["after"]).alias("right"),
        )

    def placed(i: Column) -> Column:
        left = i["left"]
        secret = F.array_join(left, " ").rlike(_LABELLED) & i["word"].rlike(_SECRET_FORM)
        return F.struct(i["start"], i["end"], F.lower(i["word"]), _contexts(left, i["right"], i["word"]), secret)

    instances = F.transform(_matches(value, _INSTANCE, None), instance)
    return out.withColumn("instances", F.transform(instances, placed).cast(_INSTANCES))


def _shape(word: Column) -> Column:
    """Digits as 9, runs of letters as a; long mixed words are told apart by their alphabet only."""
    plain = F.regexp_replace(F.regexp_replace(word, "[0-9]", "9"), r"\p{L}++", "a")
    mixed = F.when(word.rlike("^[0-9a-f]++$"), "hex").otherwise("mixed")
    return F.when(word.rlike(_SECRET_FORM), mixed).otherwise(plain)


def _contexts(left: Column, right: Column, word: Column) -> Column:
    """The patterns of an instance; none without a word on its left."""

    def last(n: int) -> Column:
        return F.when(F.size(left) >= n, F.concat_ws(" ", F.lit(f"l{n}"), F.array_join(F.slice(left, -n, n), " ")))

    near = F.element_at(left, -1)
    both = F.when(right != "", F.concat_ws(" ", F.lit("lr"), near, right))
    some = F.array_compact(F.array(last(1), last(2), last(3), both, F.concat_ws(" ", F.lit("ls"), near, _shape(word))))
    return F.when(near != "", some).otherwise(F.array().cast("array<string>"))


def _covered(i: Column) -> Column:
    return F.filter("base", lambda b: (b["start"] < i["end"]) & (b["end"] > i["start"]))


def patterns(extracted: DataFrame) -> DataFrame:
    """(context, as, confidence): the accepted patterns of an extracted corpus and the number of their kind."""
    one = extracted.select("base", F.explode("instances").alias("i")).filter("i.word <> ''")
    kind = F.coalesce(F.try_element_at(_covered(F.col("i")), F.lit(1))["kind"], F.when(F.col("i.secret"), _SECRET), F.lit(-1))
    edges = one.select(F.explode("i.contexts").alias("context"), "i.word", kind.alias("kind"))
    edges = written(edges.groupBy("context", "word", "kind").agg(F.count(F.lit(1)).alias("n")), "edges")
    scores = edges.filter("kind >= 0").select("word", "kind", F.lit(1.0).alias("score")).distinct()
    before = None
    for _ in range(TURNS):
        total = edges.groupBy("context").agg(F.sum("n").alias("total"))
        known = edges.groupBy("context", "word").agg(F.sum("n").alias("n")).join(scores, "word")
        good = known.groupBy("context", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("mass")).filter(F.col("mass") >= SUPPORT)
        rated = good.join(total, "context").select("context", "kind", (F.col("mass") / F.col("total")).alias("confidence"))
        rated = rated.filter(F.col("confidence") >= CONFIDENCE).groupBy("context").agg(F.max(F.struct("confidence", "kind")).alias("best"))
        chosen = written(rated.select("context", F.col("best.kind").alias("as"), "best.confidence"), "patterns")
        now = chosen.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(context, `as`))")).first()
        if now == before:
            break
        before = now
        fresh = edges.join(chosen, "context")
        fresh = fresh.select("word", F.col("as").alias("kind"), F.col("confidence").alias("score"))
        seen = edges.filter("kind >= 0").select("word", "kind", F.lit(1.0).alias("score"))
        scores = written(fresh.union(seen).groupBy("word", "kind").agg(F.max("score").alias("score")), "scores")
    return chosen


def found(extracted: DataFrame) -> DataFrame:
    """Add `more` to a written corpus: spans (as in base) of labelled secrets and of instances in accepted
    patterns, where no base span touches them."""
    new = F.filter("instances", lambda i: (i["end"] > i["start"]) & (F.size(_covered(i)) == 0))
    one = extracted.select(_ROW, F.explode(new).alias("i")).select(_ROW, "i.*")
    secrets = one.filter("secret").select(_ROW, "start", "end", F.lit(1.0).alias("confidence"), F.lit(_SECRET).alias("as"))
    others = one.filter("NOT secret").select(_ROW, "start", "end", F.explode("contexts").alias("context"))
    others = others.join(patterns(extracted), "context").select(_ROW, "start", "end", "confidence", "as")
    best = secrets.union(others).groupBy(_ROW, "start", "end").agg(F.max(F.struct("confidence", "as")).alias("best"))
    spans = best.select(_ROW, F.struct("start", F.col("best.as").alias("kind"), "end").alias("span"))
    more = spans.groupBy(_ROW).agg(F.array_sort(F.collect_list("span")).cast(_SPAN).alias("more"))
    return extracted.join(more, _ROW, "left").withColumn("more", F.coalesce("more", F.array().cast(_SPAN)))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span of personal data replaced by its kind in brackets.

    Spans that overlap are one, named after the first. Other columns stay as they are, but for a
    column n_chars, which is counted anew.
    """
    columns = docs.columns
    # The other columns travel in a struct, where no name can clash with those that are added.
    given = docs.select(F.struct(*[F.col(c) for c in columns if c != text]).alias(_GIVEN), F.col(text).alias("text"))
    extracted = found(written(extract(given).withColumn(_ROW, F.monotonically_increasing_id()), "private"))
    spans = F.array_sort(F.concat("base", "more"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in ALL_KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        kept = F.substring(F.col("text"), done["at"] + 1, s["start"] - done["at"])
        fresh = s["start"] >= done["at"]
        out = F.when(fresh, F.concat(done["out"], kept, F.element_at(names, s["kind"] + 1))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    whole = F.aggregate(
        spans, begin, step, lambda done: F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.char_length(F.col("text"))))
    )
    out = extracted.select(_GIVEN, F.when(F.size(spans) > 0, whole).otherwise(F.col("text")).alias("text"))
    values = {c: F.col(f"{_GIVEN}.`{c}`") for c in columns if c != text} | {text: F.col("text")}
    if "n_chars" in columns and text != "n_chars":
        values["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[values[c].alias(c) for c in columns])


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    extracted = found(written(extract(docs).drop("text").withColumn(_ROW, F.monotonically_increasing_id()), "private"))
    counts = [_count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)]
    return extracted.select(
        "doc_id",
        *counts,
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", "more"))).alias("spans"),
        F.size("more").cast("long").alias("n_found"),
        (F.size("base") + F.size("more")).cast("long").alias("n_spans"),
    )

"""Personal data: stated patterns as seeds, and a bootstrap over their contexts for what they miss.

Each text is read once. Base matches are seeds; other identifier-like strings (digits in number form,
spelled-out mail addresses) are candidates. Both are joined to the lexical patterns they stand in: the words
around them. Spark scores the graph of patterns and instances in rounds: a pattern is as reliable as the
instances it holds, a candidate as likely as its patterns make it. Candidates that reach ``ACCEPT`` through
reliable patterns, and have the form of the kind, become spans beside the base ones.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.text import slices, text_or_empty
from salestide.session import materialize

#: Kinds in the order of the digest.
KINDS = ("email", "ip", "card", "phone")
# Rounds end when the reliable patterns stay the same and no candidate's score moves by more than this.
TOLERANCE = 1e-3
# A pattern speaks for a kind from this many different instances and this share of its occurrences on.
MIN_INSTANCES = 3
MIN_CONFIDENCE = 0.6
ACCEPT = 0.8
# Occurrences that a pattern is charged with beyond those seen.
PRIOR = 1.0
# Digits of a number that may be an identifier.
_LEAST_DIGITS, _MOST_DIGITS = 7, 19

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORTH = re.compile(r"[0-9@]")
_NUMBER = re.compile(r"\(?[0-9][0-9()\x20./-]*[0-9]")
_AT = re.compile(r"\(at\)|\[at\]|\x20at\x20", re.I)
# What follows a spelled "at": labels joined by spelled or real dots.
_AFTER_AT = re.compile(r" ?[A-Za-z0-9-]{1,63}(?:(?: ?(?:\(dot\)|\[dot\]| dot ) ?|\.)[A-Za-z0-9-]{1,63}){1,8}", re.I)
_LONGEST_LOCAL = 64
_TOKEN = re.compile(r"[^\x20]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
_OCCURRENCE = pa.struct([
    ("value", pa.string()), ("kind", pa.string()), ("form", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
    ("patterns", pa.list_(pa.string())),
])
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SPAN_DDL = "struct<kind:string,start:bigint,end:bigint>"
_OCCURRENCE_DDL = "struct<value:string,kind:string,form:string,start:bigint,end:bigint,patterns:array<string>>"


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the mail pattern, each text position looked at a bounded number of times."""
    found, taken, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = taken + len(text[taken:at].rstrip(_LOCAL))
        if domain and start < at:
            found.append((start, domain.end()))
            taken = domain.end()
            at = text.find("@", taken)
        else:
            taken = at + 1
            at = text.find("@", taken)
    return found


def ips(text: str) -> list[tuple[int, int]]:
    """Four numbers joined by dots, none above 255."""
    found = []
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                found.append((at, at + size))
            at += size + 1
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _sized(pattern: re.Pattern, text: str, least: int, most: int) -> Iterator[tuple[int, int, str]]:
    for match in pattern.finditer(text):
        digits = _NOT_DIGIT.sub("", match.group())
        if least <= len(digits) <= most:
            yield match.start(), match.end(), digits


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all base matches, by kind and start."""
    if not _WORTH.search(text):
        return []
    spans = [("email", *s) for s in emails(text)] + [("ip", *s) for s in ips(text)]
    spans += [("card", a, b) for a, b, digits in _sized(_CARD, text, 13, 19) if luhn(digits)]
    spans += [("phone", a, b) for a, b, _ in _sized(_PHONE, text, 9, 15)]
    return spans


def written(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _spelled(text: str) -> Iterator[tuple[int, int]]:
    """Mail addresses with a spelled "at", each text position looked at a bounded number of times."""
    taken, at = 0, _AT.search(text)
    while at:
        domain = _AFTER_AT.match(text, at.end())
        end = at.start() - (text[at.start() - 1 : at.start()] == " ")
        least = max(taken, end - _LONGEST_LOCAL)
        start = least + len(text[least:end].rstrip(_LOCAL)) if end > least else end
        if domain and start < end:
            yield start, domain.end()
            taken = domain.end()
        at = _AT.search(text, max(taken, at.start() + 1))


def _grouped(tokens: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Tokens (start, end, digits) of an over-long run in groups: as their sizes repeat, else as many as a number may have."""
    sizes = [n for *_, n in tokens]
    for period in range(1, min(len(tokens) // 2, _MOST_DIGITS) + 1):
        if _LEAST_DIGITS <= sum(sizes[:period]) <= _MOST_DIGITS and len(sizes) % period == 0 and sizes == sizes[:period] * (len(sizes) // period):
            yield from (tokens[k : k + period] for k in range(0, len(tokens), period))
            return
    group: list[tuple[int, int, int]] = []
    for token in tokens:
        alone = token[2] >= _LEAST_DIGITS or group and group[-1][2] >= _LEAST_DIGITS
        if group and (alone or sum(n for *_, n in group) + token[2] > _MOST_DIGITS):
            yield group
            group = []
        group.append(token)
    if group:
        yield group


def _numbers(text: str) -> Iterator[tuple[int, int]]:
    """Runs of digits in number form; runs with too many digits are split at spaces, first where a parenthesis opens."""
    for match in _NUMBER.finditer(text):
        digits = len(_NOT_DIGIT.sub("", match.group()))
        if _LEAST_DIGITS <= digits <= _MOST_DIGITS:
            yield match.span()
        if digits <= _MOST_DIGITS:
            continue
        parts: list[list[tuple[int, int, int]]] = [[]]
        for token in _TOKEN.finditer(text, *match.span()):
            if token.group().startswith("("):
                parts.append([])
            parts[-1].append((*token.span(), len(_NOT_DIGIT.sub("", token.group()))))
        for part in parts:
            whole = sum(n for *_, n in part) <= _MOST_DIGITS
            for group in [part] if whole else _grouped(part):
                found = _NUMBER.search(text, group[0][0], group[-1][1]) if group else None
                if found and _LEAST_DIGITS <= len(_NOT_DIGIT.sub("", found.group())) <= _MOST_DIGITS:
                    yield found.span()


def _candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(form, start, end) of identifier-like strings that no base span touches."""
    found = [("number", *span) for span in _numbers(text)] if _WORTH.search(text) else []
    found += [("spelled", *span) for span in _spelled(text)]
    busy = [(a, b) for _, a, b in base]
    for form, a, b in found:
        if not any(x < b and a < y for x, y in busy):
            busy.append((a, b))
            yield form, a, b


def _clean(word: str) -> str:
    return re.sub(r"[0-9]+", "0", word.lower().strip(".,;!?"))


def _words_before(text: str, start: int) -> list[str]:
    """The whole last two words before a place, after others perhaps."""
    reach = 64
    while True:
        words = text[max(0, start - reach) : start].split()
        if len(words) > 2 or reach >= start:
            return words
        reach *= 4


def _words_after(text: str, end: int) -> list[str]:
    """The whole first word after a place, before others perhaps; what follows the span without a space is one."""
    reach = 32
    while True:
        words = text[end : end + reach].split()
        if len(words) > 1 or end + reach >= len(text):
            return words
        reach *= 4


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: one and two words before it, and a word on both sides."""
    before, after = _words_before(text, start), _words_after(text, end)
    one = _clean(before[-1]) if before else ""
    two = _clean(before[-2]) if len(before) > 1 else ""
    right = _clean(after[0]) if after else ""
    patterns = [f"{one} _"] if one else []
    if two:
        patterns.append(f"{two} {one} _")
    if one and right:
        patterns.append(f"{one} _ {right}")
    return patterns


def occurrences(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Seeds and candidates with the patterns they stand in."""
    out = []
    for kind, a, b in base:
        out.append({"value": text[a:b].lower(), "kind": kind, "form": "base", "start": a, "end": b, "patterns": contexts(text, a, b)})
    for form, a, b in _candidates(text, base):
        out.append({"value": text[a:b].lower(), "kind": None, "form": form, "start": a, "end": b, "patterns": contexts(text, a, b)})
    return out


def read(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``_row`` (unique), ``_key``, ``base`` spans and ``seen`` occurrences."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), text_or_empty(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, seen = [], []
            for value in batch.column("text").to_pylist():
                spans = base_spans(value)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                seen.append(occurrences(value, spans))
            columns = [batch.column("_row"), batch.column("_key"), pa.array(base, pa.list_(_SPAN)), pa.array(seen, pa.list_(_OCCURRENCE))]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "_key", "base", "seen"])

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"_row bigint, _key {kind}, base array<{_SPAN_DDL}>, seen array<{_OCCURRENCE_DDL}>")


def bootstrap(seen: DataFrame, rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidates with scores (``value``, ``form``, ``kind``, ``score``) and patterns (``pattern``, ``kind``, ``confidence``).

    ``seen`` has a row per occurrence. In each round a pattern's confidence for a kind is the score of the
    instances it holds, over all its occurrences and ``PRIOR``; a candidate's score is the probability that
    at least one of its reliable patterns is right. Seeds keep their score of 1. A pattern that falls short is
    judged again without the candidates that no pattern has scored yet and whose form suits the kind: they may
    be what it should find, and are no evidence against it. Other kinds and other forms are. Occurrences are
    summed by pattern and instance before they are joined.

    There are so many ``rounds``, or as many as change anything: they end when the reliable patterns are those of the
    round before and no score has moved by more than ``TOLERANCE``, or when patterns that were given up come back as
    they were, since they would go on in a circle.
    """
    edges = materialize(
        seen.select("value", "form", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "value", "form", "kind").agg(F.count(F.lit(1)).alias("n")),
        "pii-edges",
    )
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = edges.filter("kind is not null").select("pattern", "kind", "value", "n", F.lit(1.0).alias("score"))
    new = edges.filter("kind is null").select("pattern", "value", "form", "n")
    scores = seen.sparkSession.createDataFrame([], "value string, form string, kind string, score double")
    reliable, known_sets = None, []
    for turn in itertools.count() if rounds is None else range(rounds):
        before = scores
        held = seeds.unionByName(new.join(scores, ["value", "form"]).select("pattern", "kind", "value", "n", "score"))
        spoken = held.groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("mass"), F.countDistinct("value").alias("instances")
        )
        unscored = new.join(scores.select("value", "form").distinct(), ["value", "form"], "left_anti")
        unknown = (
            unscored.withColumn("kind", F.explode(F.array(*map(F.lit, KINDS)))).filter(_has_form())
            .groupBy("pattern", "kind").agg(F.sum("n").alias("unknown"))
        )
        whole = F.col("mass") / (F.col("total") + PRIOR)
        known = F.col("mass") / (F.col("total") - F.coalesce("unknown", F.lit(0)) + PRIOR)
        reliable = materialize(
            spoken.filter(F.col("instances") >= MIN_INSTANCES).join(totals, "pattern").join(unknown, ["pattern", "kind"], "left")
            .withColumn("confidence", F.when(whole >= MIN_CONFIDENCE, whole).otherwise(known)).filter(F.col("confidence") >= MIN_CONFIDENCE)
            .select("pattern", "kind", "confidence"),
            f"pii-patterns-{turn}",
        )
        doubt = F.sum(F.log(1 - F.col("confidence")))
        scores = materialize(
            new.join(reliable, "pattern").filter(_has_form()).groupBy("value", "form", "kind")
            .agg((1 - F.exp(doubt)).alias("score")),
            f"pii-scores-{turn}",
        )
        if rounds is None:
            mark = _mark(reliable)
            same = known_sets[-1:] == [mark]
            if mark in known_sets and not (same and _moved(before, scores)):
                break
            known_sets.append(mark)
    return scores, reliable


def _mark(reliable: DataFrame) -> tuple:
    """Stands for the set of reliable patterns, whatever their confidence."""
    hashed = F.xxhash64("pattern", "kind").cast("decimal(20)")
    return tuple(reliable.agg(F.count(F.lit(1)), F.sum(hashed), F.bit_xor(F.xxhash64("kind", "pattern"))).first())


def _moved(before: DataFrame, after: DataFrame) -> bool:
    """Whether any candidate's score has moved by more than the tolerance."""
    change = F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("was", F.lit(0.0)))
    both = after.join(before.withColumnRenamed("score", "was"), ["value", "form", "kind"], "full")
    return not both.filter(change > TOLERANCE).isEmpty()


def _has_form() -> Column:
    """Whether a candidate's form and count of digits suit the kind."""
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    dotted = F.size(F.split("value", r"\.")) == 4
    number = F.col("form") == "number"
    return (
        ((F.col("kind") == "email") & (F.col("form") == "spelled"))
        | ((F.col("kind") == "phone") & number & digits.between(7, 15))
        | ((F.col("kind") == "card") & number & digits.between(13, 19))
        | ((F.col("kind") == "ip") & number & dotted)
    )


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int | None = None) -> DataFrame:
    """One row per document: the key, ``base`` and ``added`` spans (arrays of kind, start, end in code points).

    Base spans are sorted by kind and start. Added spans touch no base span and, of the same candidate, have
    its likeliest kind. Null and empty texts have no spans; null and repeated keys are rows like others; no
    rows give no rows; other columns are not read.
    """
    stored = materialize(read(docs, key, text), "pii-read")
    seen = stored.select("_row", F.explode("seen").alias("o")).select("_row", "o.*")
    scores, _ = bootstrap(seen, rounds)
    order = F.struct("score", F.col("kind").alias("k"))
    taken = scores.filter(F.col("score") >= ACCEPT).groupBy("value", "form").agg(F.max(order)["k"].alias("found"))
    added = (
        seen.filter("kind is null").join(taken, ["value", "form"])
        .groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(F.col("found").alias("kind"), "start", "end"))).alias("added"))
    )
    empty = F.array().cast(f"array<{_SPAN_DDL}>")
    return stored.select("_row", "_key", "base").join(added, "_row", "left").select(
        F.col("_key").alias(key), "base", F.coalesce("added", empty).alias("added")
    )


def _joined(spans: Column) -> Column:
    def ranked(span):
        return F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), span["kind"]).alias("rank"), span["start"].alias("start"),
            F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string")).alias("text"),
        )

    return F.array_join(F.transform(F.array_sort(F.transform(spans, ranked)), lambda s: s["text"]), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans, and all spans as text, for each row of :func:`find`."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        key, *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("bigint").alias("n_added"),
    )


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int | None = None) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in angle brackets.

    Rows are told apart by a number of their own: each comes out once, null and repeated keys and repeated rows
    included. Of spans that overlap, the first to start is replaced, the longest of several. Null texts stay null,
    empty ones empty; no rows give no rows; other columns stay as they are, whatever their names.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), docs[text].cast("string").alias("_text"), F.struct(*docs.columns).alias("_doc")
    )
    rows = materialize(rows, "pii-rows")
    spans = find(rows, "_row", "_text", rounds).select(F.col("_row").alias("_k"), F.concat("base", "added").alias("_spans"))

    @F.pandas_udf("string")
    def masked(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_masked(*both) for both in zip(texts, found)], dtype=object)

    columns = [masked("_text", "_spans").alias(c) if c == text else F.col("_doc")[c].alias(c) for c in docs.columns]
    return rows.join(spans, rows["_row"] == spans["_k"]).select(*columns)


def _masked(text: str | None, found: Iterable[dict]) -> str | None:
    """A text with its spans replaced by their kinds."""
    if text is None:
        return None
    out, end = [], 0
    for span in sorted(found, key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= end:
            out += [text[end : span["start"]], f"<{span['kind']}>"]
            end = span["end"]
    return "".join([*out, text[end:]])

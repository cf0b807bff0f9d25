"""Personal data by bootstrapped contextual extraction.

Fixed patterns find e-mail addresses, IP addresses, card and phone numbers; they
are the seed entities.  Candidates are all runs of neighbouring words with a
digit or an ``@``.  The words around a candidate form its lexical patterns
(word before, two words before, word after, both sides); they are read from the
200 characters on either side, so a longer word counts by its part next to the
candidate, and a text without spaces takes no longer than another.  Spark then scores the
graph of patterns and instances in rounds: a pattern's confidence for a kind is
the Wilson lower bound of the share of its distinct instances that are of that
kind, weighted by their scores; an instance's score is the chance that one of
its trusted patterns is right; instances over the bar count as entities in the
next round.  Where a trusted pattern meets a promoted instance, a span is added.
The graph is the distinct (pattern, instance) pairs; hot ones are pre-aggregated
before every shuffle and never gathered.

Offsets are code points, ends exclusive.  Cases: null text is empty; a null
``doc_id`` is left out; repeated rows give one result row each, and the spans of
rows that share a ``doc_id`` are those of any of them that lie within the text;
an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import documents, record_batch, ship, steps, table

#: Fixed patterns, by kind, in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone")
_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match starts and ends with a whole run of digits: long runs are read once
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")


@dataclass(frozen=True)
class Trust:
    """Bars of the bootstrapping."""

    rounds: int = 3
    pattern: float = 0.8
    instance: float = 0.8
    least_instances: int = 5


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        m = _EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, by start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if _SIGN.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


_EDGE = ".,;:!?()[]{}<>\"'|*$%&#"


def candidates(text: str, base: list[tuple[int, int, int]]):
    """(start, end, kind number or -1, word two before, word before, word after):
    seeds, and runs of words with a digit or @ that no seed touches."""
    spots = [(a, b, k) for a, k, b in base]
    signs = [m.start() for m in _SIGN.finditer(text)]
    taken, i = sorted((a, b) for a, _, b in base), 0
    run: list[tuple[int, int]] = []
    last = -1
    for s in signs:
        if s < last:
            continue
        a = s
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        b = s
        while b < len(text) and not text[b].isspace():
            b += 1
        last = b
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if i < len(taken) and taken[i][0] < b:
            continue
        if run and text[run[-1][1] : a] == " ":
            run[-1] = (run[-1][0], b)
        else:
            run.append((a, b))
    for a, b in run:
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        if a < b:
            spots.append((a, b, -1))
    for a, b, kind in sorted(spots):
        before = text[max(0, a - 200) : a].split()[-2:]
        after = text[b : b + 200].split()[:1]
        yield a, b, kind, *(["", "", *before][-2:]), *(after or [""])


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())])
_SPANS_DDL = "array<struct<start:long,kind:long,end:long>>"
_CANDIDATE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
_SCANNED = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("base", pa.list_(_SPAN)), ("candidates", pa.list_(_CANDIDATE))])
_SCANNED_DDL = f"doc_id long, size long, base {_SPANS_DDL}, candidates array<struct<start:long,end:long,kind:int,value:string,patterns:array<string>>>"


def scanned(docs: DataFrame) -> DataFrame:
    """Per document: base spans and candidates with their
    lexical patterns."""

    def run(batches):
        for batch in steps(batches, 8 << 20):
            sizes, flat, found = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                sizes.append(len(text))
                base = base_spans(text) if _SIGN.search(text) else []
                flat.append([{"start": a, "kind": k, "end": b} for a, k, b in base])
                own = []
                if base or _SIGN.search(text):
                    for a, b, kind, two, one, after in candidates(text, base):
                        two, one, after = two.lower(), one.lower(), after.lower()
                        patterns = [f"1 {one}", f"2 {two} {one}", f"3 {after}", f"4 {one} {after}"]
                        own.append({"start": a, "end": b, "kind": kind, "value": text[a:b], "patterns": patterns})
                found.append(own)
            yield record_batch(_SCANNED, batch.column(0), sizes, pa.array(flat, _SCANNED.field(2).type), pa.array(found, _SCANNED.field(3).type))

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null").mapInArrow(run, _SCANNED_DDL)


def _wilson(hits, n):
    """Lower bound of the share ``hits / n`` at 95 of 100."""
    z2, p = 1.96**2, hits / n
    return (p + z2 / (2 * n) - 1.96 * F.sqrt((p * (1 - p) + z2 / (4 * n)) / n)) / (1 + z2 / n)


def bootstrapped(seen: DataFrame, trust: Trust) -> tuple[DataFrame, DataFrame]:
    """(trusted, promoted): patterns (pattern, kind, confidence) and instances
    (value, kind, score) that stand after the rounds."""
    places = seen.select(F.explode("candidates").alias("c")).select("c.value", "c.kind", F.explode("c.patterns").alias("pattern"))
    edges = table(places.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "graph")
    degree = edges.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= trust.least_instances)
    edges = table(edges.join(table(degree, "degree"), "pattern"), "graph")
    seeds = edges.filter("kind >= 0").select("value", "kind", F.lit(1.0).alias("score")).distinct()
    promoted, trusted = None, None
    for _ in range(trust.rounds):
        scores = seeds if promoted is None else seeds.unionByName(promoted)
        hits = edges.select("pattern", "value", "n").join(scores, "value").groupBy("pattern", "n", "kind").agg(F.sum("score").alias("hits"))
        trusted = hits.withColumn("confidence", _wilson(F.col("hits"), F.col("n"))).filter(F.col("confidence") >= trust.pattern).select("pattern", "kind", "confidence")
        trusted = table(trusted, "trusted")
        new = edges.filter("kind < 0").select("pattern", "value").join(trusted, "pattern")
        doubt = F.sum(F.log(1 - F.least("confidence", F.lit(0.999))))
        scored = new.groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score")).filter(F.col("score") >= trust.instance)
        best = scored.groupBy("value").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("top"))
        promoted = table(best.select("value", (-F.col("top.k")).alias("kind"), "top.score"), "promoted")
    return trusted, promoted


def personal_data(docs: DataFrame, trust: Trust = Trust()) -> DataFrame:
    """Per document: the base spans and all spans, each (start, kind, end)."""
    seen = table(scanned(docs), "scanned")
    trusted, promoted = bootstrapped(seen, trust)
    places = seen.select("doc_id", F.explode("candidates").alias("c")).filter("c.kind < 0").select("doc_id", "c.start", "c.end", "c.value", F.explode("c.patterns").alias("pattern"))
    met = places.join(promoted.select("value", "kind"), "value").join(trusted.select("pattern", "kind"), ["pattern", "kind"])
    added = met.select("doc_id", F.struct("start", F.col("kind").cast("long").alias("kind"), "end").alias("s")).distinct().groupBy("doc_id").agg(F.collect_list("s").alias("added"))
    empty = F.array().cast(_SPANS_DDL.replace("long", "bigint"))
    joined = seen.select("doc_id", "size", "base").join(added, "doc_id", "left")
    inside = F.filter(F.coalesce("added", empty), lambda s: s["end"] <= F.col("size"))
    return joined.select("doc_id", "base", F.array_sort(F.concat("base", inside)).alias("spans"))


def _digest(spans: str):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"].cast("int")), s["start"], s["end"])), ",")


def _number(spans: str, kind: int):
    # one parameter: a second one would be the span's index
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op8_personal(spark, sf_dir):
    found = personal_data(documents(spark, sf_dir))
    counts = [_number("base", i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_digest("base"), 256).alias("base_sha256"), _digest("spans").alias("spans"))

"""Personal data: patterns, and terms that give protected entities away.

Base spans are matches of four fixed patterns (`base_spans`).  On top of them
the corpus itself tells which terms disclose an entity: around each match the
`CONTEXT_WORDS` words on either side are its context.  With IC = -log2 p(kind)
the information of meeting an entity of a kind near a word and PMI(term; kind)
what the term tells about it,

    IC(kind) - PMI(term; kind) = -log2 (occurrences near the kind / all occurrences)

is how many bits of the entity the term leaves hidden.  A term that leaves at
most `HIDDEN_BITS` and is seen in at least `SUPPORT` different contexts
discloses the kind: inside contexts of that kind it is generalised to a label,
or removed if it leaves at most `REMOVED_BITS`.  Copies of a context count
once towards the support, so a copied text cannot make its own words suspect.

The same is asked of every single entity, that is, of all mentions of one
value: IC(entity) - PMI(term; entity) is -log2 (occurrences near the entity /
all occurrences).  Here chance decides instead of a fixed support: a term that
leaves at most `HIDDEN_BITS` discloses the entity if words that fell at random
would stand in so many contexts of it with a probability of at most `CHANCE`
(a binomial tail, for as many terms as the corpus has words).  It is replaced
near that entity only.

All counts are over all documents.  Null texts count as empty; repeated rows
each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.llm.common import col, field, small_side, stable, whole_row

KINDS = ("email", "ip", "card", "phone")
#: Spans that the corpus statistics add.
TERM = "term"
CONTEXT_WORDS = 6
SUPPORT = 5
HIDDEN_BITS = 1.0
REMOVED_BITS = 0.1
CHANCE = 0.01

# --- base spans ---------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match takes the whole run of digits, so one can only begin at a run's start:
# with that said, long runs are read once.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORDS = regex.compile(r"[\p{L}\p{N}]+")
_JAVA_WORDS = r"[\p{L}\p{N}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)


def _emails(text: str):
    """Matches of the email pattern: each @ with the local characters before
    it, back to the last match, and a domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, by start and kind."""
    found = [(s, 0, e) for s, e in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(found)


def entity(text: str, kind: int) -> int:
    """Hash of the kind and value of a match, however it is written."""
    if KINDS[kind] == "ip":
        value = ".".join(p.lstrip("0") or "0" for p in text.split("."))
    else:
        value = text.translate(_TO_LOWER) if KINDS[kind] == "email" else re.sub("[^0-9]", "", text)
    return int.from_bytes(hashlib.blake2b(f"{kind} {value}".encode(), digest_size=8).digest(), "big", signed=True)


def contexts(text: str, spans: list[tuple[int, int, int]], width: int = CONTEXT_WORDS) -> list[dict]:
    """Terms within `width` words of a span and outside all spans: `term`
    (A-Z lowered), `start`, `end`, `kind`, `context` (a hash of all its terms),
    `once` (1 for the first entry of a place and kind, else 0), `value` (see
    `entity`), `own` (1 for the first entry of a place and value, else 0)."""
    starts, ends, taken = array("q"), array("q"), bytearray()
    last, more = max((e for _, _, e in spans), default=0), 0
    for a, b, over in _words(text, spans):
        starts.append(a)
        ends.append(b)
        taken.append(over)
        more += a >= last
        if more == width:
            break
    out, seen = [], set()
    for start, kind, end in spans:
        before, behind = bisect_right(ends, start), bisect_left(starts, end)
        beside = (*range(max(0, before - width), before), *range(behind, min(behind + width, len(starts))))
        near = [(starts[i], ends[i], text[starts[i] : ends[i]].translate(_TO_LOWER)) for i in beside if not taken[i]]
        mark = zlib.crc32(" ".join(t for _, _, t in near).encode())
        value = entity(text[start:end], kind)
        for a, b, t in near:
            out.append({"term": t, "start": a, "end": b, "kind": kind, "context": mark, "once": int((a, kind) not in seen), "value": value, "own": int((a, kind, value) not in seen)})
            seen |= {(a, kind), (a, kind, value)}
    return out


def inside(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """Terms (A-Z lowered) of the words that overlap a span, one per place."""
    return [text[a:b].translate(_TO_LOWER) for a, b, over in _words(text, spans) if over]


def _words(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bool]]:
    """(start, end, overlaps a span) of every word of a text with spans."""
    i, reach = 0, 0
    for m in _WORDS.finditer(text) if spans else ():
        a, b = m.span()
        while i < len(spans) and spans[i][0] < b:
            reach = max(reach, spans[i][2])
            i += 1
        yield a, b, reach > a


_FOUND = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "kind", "end")]))
_NEAR = T.ArrayType(T.StructType([T.StructField("term", T.StringType())] + [T.StructField(c, t) for c, t in (
    ("start", T.IntegerType()), ("end", T.IntegerType()), ("kind", T.IntegerType()), ("context", T.LongType()), ("once", T.IntegerType()),
    ("value", T.LongType()), ("own", T.IntegerType()))]))


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = CONTEXT_WORDS) -> DataFrame:
    """Per row: `doc_id`, `hash` (of the text), `found` (base spans), `near`
    (context terms) and `inside` (terms in base spans)."""
    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("hash", T.LongType()), T.StructField("found", _FOUND), T.StructField("near", _NEAR),
                           T.StructField("inside", T.ArrayType(T.StringType()))])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for b in batches:
            found, near, within = [], [], []
            for t in b.column(2):
                t = t.as_py() or ""
                spans = base_spans(t)
                found.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                near.append(contexts(t, spans, width) if spans else [])
                within.append(inside(t, spans))
            made = [pa.array(v, arrow.field(2 + i).type) for i, v in enumerate((found, near, within))]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow.field(0).type), b.column(1), *made], schema=arrow)

    text = col(text_col).cast("string")
    return docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text")).mapInArrow(run, schema)


# --- corpus statistics ------------------------------------------------------------------

def disclosing_terms(docs: DataFrame, marked: DataFrame, text_col: str = "text", width: int = CONTEXT_WORDS, support: int = SUPPORT, hidden_bits: float = HIDDEN_BITS) -> DataFrame:
    """`term`, `kind`, `value` (null: any of the kind), `hidden` (bits) of the
    terms that disclose a kind or an entity.  All counts are places outside
    base spans, of every row."""
    # a term may stand near several entities of a kind: its place counts once
    counts = stable(near_terms(marked).groupBy("term", "kind", "value", "context").agg(F.sum("once").alias("n"), F.sum("own").alias("n_own")))
    kinds = stable(counts.groupBy("term", "kind", "context").agg(F.sum("n").alias("n")).groupBy("term", "kind").agg(F.sum("n").alias("n_near"), F.count(F.lit(1)).alias("contexts")))
    entities = counts.groupBy("term", "kind", "value").agg(F.sum("n_own").alias("n_near"), F.count(F.lit(1)).alias("contexts"))
    # one context is never beyond chance, and a term occurs at least where it is near the kind
    entities = entities.where(F.col("contexts") > 1).join(kinds.select("term", "kind", F.col("n_near").alias("n_kind")), ["term", "kind"])
    entities = entities.where(F.col("n_near") >= F.col("n_kind") * 2.0**-hidden_bits).drop("n_kind")
    sizes = counts.groupBy("kind", "value").agg(F.count_distinct("context").alias("entity_contexts"))
    suspects = kinds.where(F.col("contexts") >= support).withColumns({"value": F.lit(None).cast("long"), "entity_contexts": F.lit(None).cast("long")})
    suspects = stable(suspects.unionByName(entities.join(sizes, ["kind", "value"])))
    terms = stable(suspects.select("term").distinct().withColumn("known", F.lit(True)))
    words = F.regexp_extract_all(F.translate(F.coalesce(col(text_col).cast("string"), F.lit("")), _UPPER, _LOWER), F.lit(_JAVA_WORDS), F.lit(0))
    tokens = docs.select(F.explode(words).alias("term"))
    # one pass, however many suspects: words are counted where they are read,
    # and what is no suspect adds up under a null term
    counted = tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n_all")).join(terms, "term", "left")
    totals = stable(counted.groupBy(F.expr("if(known, term, null)").alias("term")).agg(F.sum("n_all").alias("n_all")))
    n_words = totals.agg(F.coalesce(F.sum("n_all"), F.lit(0))).first()[0]
    within = marked.select(F.explode("inside").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_in"))
    outside = F.greatest(F.col("n_all") - F.coalesce("n_in", F.lit(0)), "n_near")
    found = suspects.join(totals, "term").join(within, "term", "left").withColumn("outside", outside)
    hidden = -F.log2(F.col("n_near") / F.col("outside"))
    telling = F.col("value").isNull() | beyond_chance(F.col("contexts"), F.col("contexts") + F.col("outside") - F.col("n_near"), 2 * width * F.col("entity_contexts"), max(n_words, 1))
    return found.withColumn("hidden", hidden).where((F.col("hidden") <= hidden_bits) & telling).select("term", "kind", "value", "hidden")


def beyond_chance(k: Column, n: Column, near: Column, words: int, chance: float = CHANCE) -> Column:
    """Whether `k` of `n` random words fall on `near` of all `words` places with
    a probability of at most `chance` / `words` (Chernoff's bound of the tail)."""
    share = F.least(F.lit(1.0), near / F.lit(words))
    bits = k * F.log2(k / n / share) + F.when(n > k, (n - k) * F.log2((n - k) / n / (1 - share))).otherwise(0.0)
    return (k / n > share) & (bits >= math.log2(words / chance))


def near_terms(marked: DataFrame) -> DataFrame:
    """The entries of `near` of every row, with `doc_id` and `hash`."""
    return marked.where(F.size("near") > 0).select("doc_id", "hash", F.explode("near").alias("n")).select("doc_id", "hash", "n.*")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = CONTEXT_WORDS, support: int = SUPPORT, hidden_bits: float = HIDDEN_BITS):
    """(marked rows, term spans): `mark`'s result, stored, and per document
    with disclosing terms `doc_id`, `hash`, `terms` (start, kind, end, hidden)."""
    marked = stable(mark(docs, id_col, text_col, width))
    telling = stable(disclosing_terms(docs, marked, text_col, width, support, hidden_bits))
    near, place = near_terms(marked), ["doc_id", "hash", "start", "end", "kind", "hidden"]
    kinds, entities = telling.where(F.col("value").isNull()).drop("value"), telling.where(F.col("value").isNotNull())
    hits = near.join(small_side(kinds, kinds.count()), ["term", "kind"]).select(place)
    hits = hits.unionByName(near.join(small_side(entities, entities.count()), ["term", "kind", "value"]).select(place))
    # a term between two entities discloses the kind it hides least of
    hits = hits.groupBy("doc_id", "hash", "start", "end").agg(F.min(F.struct("hidden", "kind")).alias("h"))
    span = F.struct("start", F.col("h.kind").alias("kind"), "end", F.col("h.hidden").alias("hidden"))
    terms = hits.groupBy("doc_id", "hash").agg(F.array_sort(F.collect_list(span)).alias("terms"))
    return marked, stable(terms)


def with_terms(rows: DataFrame, terms: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """`rows` with the column `terms` of their document (null without any)."""
    side = terms.select(F.col("doc_id").alias("_tid"), F.col("hash").alias("_thash"), "terms")
    on = (col(hash_col) == F.col("_thash")) & col(id_col).eqNullSafe(F.col("_tid"))
    return rows.join(small_side(side, terms.count()), on, "left").drop("_tid", "_thash")


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: `doc_id`, `base` and `spans`, arrays of (start, rank, end, kind):
    the base spans, and these with the disclosing terms, by start and rank."""
    marked, terms = find(docs, id_col, text_col, **options)
    rows = with_terms(marked.select("doc_id", "hash", "found"), terms, "doc_id", "hash")
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    base = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("rank"), s["end"].alias("end"), F.get(names, s["kind"]).alias("kind")))
    added = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,kind:int,end:int,hidden:double>>")),
                        lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), s["end"].alias("end"), F.lit(TERM).alias("kind")))
    return rows.select("doc_id", base.alias("base"), F.array_sort(F.concat(base, added)).alias("spans"))


# --- sanitisation --------------------------------------------------------------------------

def _clean(text: str, terms: list[dict] | None, removed_bits: float) -> str:
    """`text` with base spans replaced by their kind, disclosing terms by a
    label or nothing; overlapping spans become one."""
    cuts = [(s, e, f"[{KINDS[k].upper()}]") for s, k, e in base_spans(text)]
    cuts += [(t["start"], t["end"], "" if t["hidden"] <= removed_bits else f"[{KINDS[t['kind']].upper()}-TERM]") for t in terms or []]
    out, done = [], 0
    for s, e, label in sorted(cuts):
        if s >= done:
            out += [text[done:s], label]
        done = max(done, e)
    return "".join(out) + text[done:] if cuts else text


def sanitize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_bits: float = REMOVED_BITS, **options) -> DataFrame:
    """`docs` with its texts sanitised; null texts stay null."""
    _, terms = find(docs, id_col, text_col, **options)
    text = col(text_col).cast("string")
    rows = docs.select(whole_row(docs).alias("row"), text.alias("text"), col(id_col).alias("_rid"), F.xxhash64(text).alias("_rhash"))
    rows = with_terms(rows, terms, "_rid", "_rhash")
    others = [c for c in docs.columns if c != text_col]
    slim = rows.select(F.struct(F.lit(0).alias("_"), *[F.col("row")[c].alias(c) for c in others]).alias("row"), "text", "terms")
    schema = T.StructType([slim.schema["row"], T.StructField("text", T.StringType())])

    def run(batches):
        for b in batches:
            done = [None if t is None else _clean(t, terms, removed_bits) for t, terms in ((t.as_py(), x.as_py()) for t, x in zip(b.column(1), b.column(2)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done, pa.string())], names=["row", "text"])

    out = slim.mapInArrow(run, schema)
    return out.select(*[(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])

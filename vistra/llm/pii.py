"""Personal data: exact rules, and contextual extraction bootstrapped from them.

The rules' finds are the seed entities. Around each seed and around every other
identifier-like run (numbers with blanks, brackets, dots and hyphens, tokens
with an @ or many digits, spelled-out addresses) stand lexical patterns (the
words before, after, and on both sides). Patterns and instances (the runs'
values) form a graph, and Spark scores it in rounds: a pattern is as good for a
kind as the share of its different instances that are known to be of that kind,
and an instance as sure as its patterns together make it. Sure instances join
the known ones for the next round, until a round finds no new one. What is sure
and the rules did not see is added to the spans; the rules' spans always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm.common import stored, table, texts_of, trimmed

KINDS = ["email", "ip", "card", "phone"]

# --- fixed values: the base patterns ------------------------------------------------
# Possessive forms of the stated patterns. They find the same matches, because no
# repeated class shares a character with what follows it, and take linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# --- end of fixed values --------------------------------------------------------

# Scoring. A pattern counts once it has so many different known instances of one
# kind and such a share of all its instances; an instance is sure from SURE on.
LEAST_SEEDS = 5
LEAST_SHARE = 0.8
SURE = 0.95
# What may be an identifier: a spelled-out address, a token with an @, or a token
# or a run of numbers with at least LEAST_DIGITS digits.
LEAST_DIGITS = 6
# The instances of so many rounds are written as one table, so that a plan reads
# few tables however many rounds there are.
ROUNDS_APART = 8
_EDGES = "\"'()[]{}<>.,;:!?"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def find_emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def find_ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find_cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def find_phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


_DIGITS = bytes(range(48, 58))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of the rules' finds, by kind, then start."""
    out = []
    if "@" in text:
        out += [(0, *s) for s in find_emails(text)]
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw.translate(None, _DIGITS)) != len(raw):
        out += [(1, *s) for s in find_ips(text)]
        out += [(2, *s) for s in find_cards(text)]
        if "+" in text:
            out += [(3, *s) for s in find_phones(text)]
    return out


_RUN = re.compile(r"\S+")
_LIKELY = re.compile(r"[0-9@]")


LONG_WORD = 32
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_UNDO = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 16


def _plain(text: str) -> str:
    return re.sub("[0-9]", "0", text.lower())


def _sums(word: str) -> np.ndarray:
    """Prefix sums of code * _BASE**place, modulo 2**64; A-Z as a-z, digits alike.

    A part's hash comes from two of them, so that the many places which one long
    word may hold cost no new reading of it.
    """
    out = np.zeros(len(word) + 1, np.uint64)
    powers = np.cumprod(np.full(min(len(word), _BLOCK), _BASE, np.uint64))
    for at in range(0, len(word), _BLOCK):
        codes = np.frombuffer(word[at : at + _BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        codes[(codes >= 65) & (codes <= 90)] += np.uint64(32)
        codes[(codes >= 48) & (codes <= 57)] = 48
        block = np.cumsum(codes * powers[: len(codes)]) * np.uint64(pow(_BASE, at, 1 << 64))
        out[at + 1 : at + 1 + len(codes)] = block + out[at]
    return out


class Context:
    """The words of a text around its places.

    A context word is in lower case, digits alike; one of over LONG_WORD letters
    is its first letters and a hash of all.
    """

    def __init__(self, text: str):
        self.text = text
        spans = [m.span() for m in _RUN.finditer(text)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]
        self.sums: dict[int, np.ndarray] = {}  # of the long words near the last place

    def _word(self, i: int, start: int, end: int) -> str:
        if end - start <= LONG_WORD:
            return _plain(self.text[start:end])
        if i not in self.sums:
            self.sums = {k: v for k, v in self.sums.items() if abs(k - i) <= 4}
            self.sums[i] = _sums(self.text[self.starts[i] : self.ends[i]])
        first, last = start - self.starts[i], end - self.starts[i]
        code = (int(self.sums[i][last]) - int(self.sums[i][first])) * pow(_UNDO, first, 1 << 64) % (1 << 64)
        return f"{_plain(self.text[start : start + 24])}~{code:016x}"

    def before(self, at: int, n: int = 2) -> list[str]:
        """The last words before ``at``; one that ``at`` stands in counts up to there."""
        last = bisect_left(self.starts, at)
        return [self._word(i, self.starts[i], min(self.ends[i], at)) for i in range(max(0, last - n), last)]

    def after(self, at: int, n: int = 2) -> list[str]:
        first = bisect_right(self.ends, at)
        return [self._word(i, max(self.starts[i], at), self.ends[i]) for i in range(first, min(first + n, len(self.ends)))]


_NUMBER = re.compile(r"\+?[0-9][0-9().\[\]/+–-]*+")
# Between the numbers of a run, on one line: a bracket, blanks, a hyphen, slash or lone dot.
_JOIN = re.compile(r"[)\]]?+[ \t\xa0]*+(?:[/–-]|(?<=[ \t\xa0])\.(?=[ \t\xa0]))?+[ \t\xa0]*+[(\[]?+")
_BLANKS = " \t\xa0"
_AT = re.compile(r"[\[({][ \t\xa0]*+(?:[aA][tT]|@)[ \t\xa0]*+[\])}]|(?<=[ \t\xa0])(?:[aA][tT]|@)(?=[ \t\xa0])")
_SPELLED = re.compile(
    r"[ \t\xa0]*+[A-Za-z0-9-]++"
    r"(?:(?:\.|[ \t\xa0]*+[\[({][ \t\xa0]*+(?:[dD][oO][tT]|\.)[ \t\xa0]*+[\])}][ \t\xa0]*+|[ \t\xa0]++[dD][oO][tT][ \t\xa0]++)[A-Za-z0-9-]++)++"
)


def _back(text: str, at: int, least: int, over) -> int:
    while at > least and text[at - 1] in over:
        at -= 1
    return at


def _dot_before(text: str, at: int, least: int) -> int:
    """Where a spelled-out dot (in brackets or between blanks) that ends at ``at`` begins; -1: there is none."""
    end = _back(text, at, least, _BLANKS)
    bracket = end > least and text[end - 1] in "])}"
    word = _back(text, end - 1, least, _BLANKS) if bracket else end
    if word - 3 < least or text[word - 3 : word].lower() != "dot":
        return -1
    start = _back(text, word - 3, least, _BLANKS)
    if bracket:
        return _back(text, start - 1, least, _BLANKS) if start > least and text[start - 1] in "[({" else -1
    return start if end < at and start < word - 3 else -1


def spelled_addresses(text: str) -> list[tuple[int, int]]:
    """Addresses such as ``bob at host dot org`` or ``bob[at]host.org``."""
    out, last = [], 0
    for m in _AT.finditer(text):
        domain = _SPELLED.match(text, m.end())
        if domain and m.start() >= last and not domain[0][-1].isdigit():
            end = _back(text, m.start(), last, _BLANKS)
            start = _back(text, end, last, _LOCAL)
            if start < end:
                while (dot := _dot_before(text, start, last)) >= 0 and (further := _back(text, dot, last, _LOCAL)) < dot:
                    start = further
                out.append((start, domain.end()))
                last = domain.end()
                continue
        last = max(last, m.end())
    return out


def likely_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Identifier-like runs in order, apart from tokens that overlap ``taken`` (sorted spans)."""
    out: list[tuple[int, int]] = []
    run: list[int] = []  # start and end of the run of numbers so far

    def flush():
        if run:
            start, end = run
            if len(_digits(text[start:end])) >= LEAST_DIGITS:
                # the bracket of a number's first part belongs to it: (663) 555-6869
                for left, right in ("()", "[]"):
                    inner = text[start:end]
                    if start and text[start - 1] == left and inner.count(right) > inner.count(left):
                        start -= 1
                out.append((start, end))
            run.clear()

    at, seen = 0, 0
    for hit in _LIKELY.finditer(text):
        if hit.start() < seen:
            continue
        start = hit.start()
        while start > seen and not text[start - 1].isspace():
            start -= 1
        first, end = start, _RUN.match(text, start).end()
        seen = end
        while start < end and text[start] in _EDGES:
            start += 1
        while end > start and text[end - 1] in _EDGES:
            end -= 1
        while at < len(taken) and taken[at][1] <= first:
            at += 1
        if at < len(taken) and taken[at][0] < seen:
            flush()
            continue
        if _NUMBER.fullmatch(text, start, end):
            if run and _JOIN.match(text, run[1]).end() == start:
                run[1] = end
            else:
                flush()
                run += [start, end]
            continue
        flush()
        value = text[start:end]
        if "@" in value or len(_digits(value)) >= LEAST_DIGITS:
            out.append((start, end))
    flush()
    return out


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str]]]:
    """(kind or -1, start, end, value, patterns) of seeds and of other likely identifiers.

    A seed that lies within another one (a card's digits in a phone, say) and
    what overlaps any seed gives no mention.
    """
    found, last = [], -1
    for start, _, end, kind in sorted((s, -e, e, k) for k, s, e in base):
        if start >= last:
            found.append((kind, start, end))
            last = end
    taken, at, seeds = [(s, e) for _, s, e in found], 0, len(found)
    for start, end in spelled_addresses(text):
        while at < seeds and taken[at][1] <= start:
            at += 1
        if at == seeds or taken[at][0] >= end:
            found.append((-1, start, end))
    if len(found) > seeds:
        taken = sorted((s, e) for _, s, e in found)
    found += [(-1, s, e) for s, e in likely_spans(text, taken)]
    out, context = [], Context(text) if found else None
    for kind, start, end in sorted(found, key=lambda x: x[1]):
        left, right = context.before(start), context.after(end)
        patterns = []
        if len(left) == 2:
            patterns.append(f"{left[0]} {left[1]} *")
        if len(right) == 2:
            patterns.append(f"* {right[0]} {right[1]}")
        if left and right:
            patterns.append(f"{left[-1]} * {right[0]}")
        out.append((kind, start, end, text[start:end], patterns))
    return out


_SPANS = "array<struct<kind:int,start:int,end:int>>"


def scan(docs: DataFrame, keep: list[str], key: str, text: str) -> DataFrame:
    """Per row: row number, kept columns, base spans and mentions. No shuffle."""
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    mention = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
    names = ["_key", *(f"_keep{i}" for i in range(len(keep)))]
    source = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), *[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)])

    def find(batches):
        for batch in batches:
            texts = texts_of(batch, "_text")
            base = [base_spans(t) for t in texts]
            around = [mentions(t, b) for t, b in zip(texts, base, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    *[batch.column(n) for n in names],
                    pa.array([[dict(zip(("kind", "start", "end"), x)) for x in b] for b in base], pa.list_(span)),
                    pa.array([[dict(zip(("kind", "start", "end", "value", "patterns"), x)) for x in a] for a in around], pa.list_(mention)),
                ],
                names=["_row", *names, "base", "mentions"],
            )

    kinds = [docs.schema[key].dataType, *(docs.schema[c].dataType for c in keep)]
    ddl = ", ".join(["_row bigint", *(f"{n} {k.simpleString()}" for n, k in zip(names, kinds)), f"base {_SPANS}", "mentions array<struct<kind:int,start:int,end:int,value:string,patterns:array<string>>>"])
    return source.mapInArrow(trimmed(find), ddl)


def score_patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, kind, seeds, share) of good patterns.

    ``edges``: distinct (pattern, value). ``known``: distinct (value, kind). The
    counts are sums of partial counts, so a very common pattern needs no task
    of its own.
    """
    labelled = edges.join(known, "value", "left")
    counts = labelled.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("instances"), *[F.count_if(F.col("kind") == i).alias(f"k{i}") for i in range(len(KINDS))]
    )
    ranked = F.array_sort(F.array(*[F.struct((-F.col(f"k{i}")).alias("seeds"), F.lit(i).alias("kind")) for i in range(len(KINDS))]))
    best = counts.select("pattern", "instances", F.element_at(ranked, 1).alias("best"))
    return best.select(
        "pattern", F.col("best.kind").alias("kind"), (-F.col("best.seeds")).alias("seeds"), (-F.col("best.seeds") / F.col("instances")).alias("share")
    ).filter((F.col("seeds") >= LEAST_SEEDS) & (F.col("share") >= LEAST_SHARE))


def score_instances(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """(value, kind, sure): 1 less the product of its patterns' doubts, best kind first."""
    doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("share"), F.lit(1e-6)))))
    by_kind = edges.join(patterns, "pattern").groupBy("value", "kind").agg((1 - doubt).alias("sure"))
    best = by_kind.groupBy("value").agg(F.max(F.struct("sure", -F.col("kind"))).alias("best"))
    return best.select("value", (-F.col("best.col2")).alias("kind"), F.col("best.sure").alias("sure"))


def bootstrap(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(instances found sure: value, kind, sure; the last round's patterns) from mentions.

    ``seen``: kind (-1: unknown), value, patterns. A value that the rules know
    under any kind is known; an instance once sure stays so, and rounds go on
    until nothing new is sure.
    """
    edges = stored(seen.select(F.explode("patterns").alias("pattern"), "value").distinct(), "pii-edges")
    seeds = stored(seen.filter("kind >= 0").groupBy("value").agg(F.min("kind").alias("kind")), "pii-seeds")
    unknown = edges.join(seeds, "value", "left_anti")
    found, apart, patterns = None, 0, score_patterns(edges, seeds)
    while True:
        sure = score_instances(unknown, patterns).filter(F.col("sure") >= SURE)
        new = stored(sure if found is None else sure.join(found, "value", "left_anti"), "pii-found")
        found, apart = (new, 1) if found is None else (found.unionByName(new), apart + 1)
        if new.isEmpty():
            return found, patterns
        if apart == ROUNDS_APART:
            found, apart = stored(found, "pii-found-so-far"), 1
        patterns = score_patterns(edges, seeds.unionByName(found.select("value", "kind")))


def hidden_recall(docs: DataFrame, every: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What the patterns find without the rules: (kind, hidden, found, right), a row per kind with hidden values.

    One in ``every`` different values that the rules find, chosen by a hash, is
    taken from the seeds and stands with the unknown ones, which lowers the share
    of its patterns: ``every`` should be well above 1 / (1 - LEAST_SHARE). ``hidden`` counts
    these, ``found`` those that bootstrapping is sure of again, ``right`` those
    under their own kind. Empty tables and tables without seeds give no row.
    """
    found = stored(scan(docs, [], key, text), "pii-scan")
    seen = found.select(F.explode("mentions").alias("m")).select("m.kind", "m.value", "m.patterns")
    away = F.pmod(F.xxhash64("value"), F.lit(every)) == 0
    sure, _ = bootstrap(seen.withColumn("kind", F.when(away, -1).otherwise(F.col("kind"))))
    hidden = seen.filter((F.col("kind") >= 0) & away).groupBy("value").agg(F.min("kind").alias("kind"))
    again = hidden.join(sure.select("value", F.col("kind").alias("again")), "value", "left")
    counts = [F.count(F.lit(1)).alias("hidden"), F.count("again").alias("found"), F.count_if(F.col("again") == F.col("kind")).alias("right")]
    names = F.array(*[F.lit(k) for k in KINDS])
    return again.groupBy("kind").agg(*counts).withColumn("kind", F.element_at(names, F.col("kind") + 1))


def span_text(spans: F.Column) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, keep: list[str] = (), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with doc_id, the columns named in ``keep``, ``base`` and ``spans``.

    Spans are (kind index, start, end) in code points, end exclusive, by kind
    and start. Null text: empty. Null and repeated ids are rows of their own.
    """
    found = stored(scan(docs, list(keep), key, text), "pii-scan")
    seen = found.filter(F.size("mentions") > 0).select("_row", F.explode("mentions").alias("m")).select("_row", "m.*")
    sure, _ = bootstrap(seen.select("kind", "value", "patterns"))
    # the rules' own spans are already there; these are the others, a few per row
    added = (
        seen.filter("kind < 0")
        .select("_row", "value", "start", "end")
        .join(sure.select("value", "kind"), "value")
        .groupBy("_row")
        .agg(F.collect_list(F.struct(F.col("kind").cast("int").alias("kind"), "start", "end")).alias("added"))
    )
    added = stored(added, "pii-added")  # its size is known then, and a small one is not worth a shuffle of all rows
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(_SPANS))))
    joined = found.join(added, "_row", "left").withColumn("spans", every)
    names = {f"_keep{i}": c for i, c in enumerate(keep)}
    columns = [F.col("_key").alias(key)] if key not in keep else []
    return joined.select(*columns, *[F.col(n).alias(c) for n, c in names.items()], "base", "spans")


def mask_spans(texts: DataFrame, text: str = "text") -> DataFrame:
    """``text`` with each span of ``spans`` as [KIND]; overlapping spans as one, named by the first."""
    names = [k.upper() for k in KINDS]

    def mask(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for t, spans in zip(batch.column(text).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if spans:
                    parts, end = [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= end:
                            parts += [t[end : s["start"]], f"[{names[s['kind']]}]"]
                        end = max(end, s["end"])
                    t = "".join([*parts, t[end:]])
                out.append(t)
            yield batch.set_column(at, text, pa.array(out, batch.schema.field(at).type))

    return texts.mapInArrow(trimmed(mask), texts.schema)


def op1_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return digest(find_pii(table(spark, sf_dir, "documents")))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: counts and a digest of the base spans, and all spans and their number."""

    def count(i: int) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"), F.size("spans").cast("bigint").alias("n_spans"))

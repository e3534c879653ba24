"""Chat formatting with loss masks aligned by offsets.

A conversation becomes one text: for each turn ``<|turn|>ROLE<|say|>TEXT<|end|>``
and a line feed. Inside roles and texts ``\\`` becomes ``\\\\`` and ``<`` becomes
``\\l``, so that no marker can occur in them and the way back is exact. The text
is encoded once with offsets, and the turns whose text is trained on (role
``assistant``) are found among the sorted token spans by binary search. Markers
are added to the tokenizer as special strings, so no token holds both marker
and text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.llm.common import process_value, stored, table, tokenizer_path

TURN, SAY, END = "<|turn|>", "<|say|>", "<|end|>"
LOSS_ROLE = "assistant"
# A conversation is rendered and encoded whole up to so many turns or
# characters; a longer one in segments of so many, cut between turns.
SEGMENT_TURNS = 256
SEGMENT_CHARS = 4_000_000

_PLAIN = {"\\": "\\", "l": "<"}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text) if "\\" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns, and each turn's text span in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + SAY, escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at = spans[-1][1] + len(END) + 1
    return "".join(parts), spans


_TURN = re.compile(r"<\|turn\|>([^<]*)<\|say\|>([^<]*)<\|end\|>\n")


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text; exact inverse of ``render``."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return turns


def chat_tokenizer(name: str):
    """The file's tokenizer with the three markers as special strings."""

    def make():
        from tokenizers import AddedToken, Tokenizer

        t = Tokenizer.from_file(tokenizer_path(name))
        t.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in (TURN, SAY, END)])
        return t

    return process_value(("chat", name), make)


def masked_tokens(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each span the range [first, last) of tokens that overlap it.

    Token starts and ends are both non-decreasing, so two binary searches do.
    """
    if not len(offsets) or not len(spans):
        return np.zeros((len(spans), 2), dtype=np.int64)
    first = np.searchsorted(offsets[:, 1], spans[:, 0], side="right")
    last = np.searchsorted(offsets[:, 0], spans[:, 1], side="left")
    return np.stack([first, np.maximum(first, last)], axis=1)


def format_conversations(
    turns: DataFrame, tokenizer: str = "byte_bpe_50k.json", loss_role: str = LOSS_ROLE, segment_turns: int = SEGMENT_TURNS
) -> DataFrame:
    """conv_id, segment, piece, formatted, ids, loss_tokens, loss_chars.

    ``turns``: conv_id, turn, role, text (others ignored). ``ids`` holds
    little-endian unsigned 32-bit integers; ``loss_tokens`` the token ranges
    [first, last) under the mask; ``loss_chars`` the characters of ``formatted``
    that those tokens cover. Null role or text: empty. Turns of one conversation
    follow each other by turn, then role, then text, null turns first; a null
    conv_id is a conversation of its own. A conversation of up to 256 turns is
    one row; a longer one has a row for each 256 turn numbers (and at most 4
    million characters), so that it needn't fit into one task.
    """
    schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("segment", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()), ("ids", pa.binary()),
            ("loss_tokens", pa.list_(pa.int64())), ("loss_chars", pa.list_(pa.int64())),
        ]
    )

    def encode(key, piece, rows):
        text, spans = render(rows)
        e = chat_tokenizer(tokenizer).encode_batch([text], add_special_tokens=False)[0]
        offsets = np.array(e.offsets, dtype=np.int64).reshape(-1, 2)
        wanted = np.array([s for s, (r, _) in zip(spans, rows, strict=True) if r == loss_role], dtype=np.int64).reshape(-1, 2)
        ranges = masked_tokens(offsets, wanted)
        chars = [(int(offsets[a, 0]), int(offsets[a:b, 1].max())) if b > a else (int(s), int(s)) for (a, b), (s, _) in zip(ranges, wanted, strict=True)]
        return (*key, piece, text, np.array(e.ids, dtype="<u4").tobytes(), ranges.ravel().tolist(), [x for c in chars for x in c])

    def segments(batches):
        key, piece, rows, chars, out = None, 0, [], 0, []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for conv, segment, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "role", "text")), strict=True):
                full = chars >= SEGMENT_CHARS or len(rows) >= 4 * segment_turns
                if rows and (key != (conv, segment) or full):
                    out.append(encode(key, piece, rows))
                    piece = piece + 1 if key == (conv, segment) else 0
                    rows, chars = [], 0
                key = (conv, segment)
                rows.append((role or "", text or ""))
                chars += len(rows[-1][1])
            if len(out) >= 200 or sum(len(o[3]) for o in out) > 8_000_000:
                yield flush()
                out = []
        if rows:
            out.append(encode(key, piece, rows))
        if out:
            yield flush()

    order = ["conv_id", "segment", "turn", "role", "text"]
    source = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    ).withColumn("segment", F.coalesce(F.floor(F.col("turn") / segment_turns).cast("bigint"), F.lit(-(2**62))))
    ddl = "conv_id bigint, segment bigint, piece bigint, formatted string, ids binary, loss_tokens array<bigint>, loss_chars array<bigint>"
    return source.repartition("conv_id", "segment").sortWithinPartitions(*order).mapInArrow(segments, ddl)


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation what its stored output says: turns and text under the loss mask.

    A conversation's digests run over its segments in order, one at a time.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def read(batches):
        state = None
        for batch in batches:
            out = []
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_chars")), strict=True):
                if state is None or state[0] != conv:
                    if state:
                        out.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for a, b in zip(spans[::2], spans[1::2]):
                    said = unescape(text[a:b])
                    state[3] += len(said)
                    state[4].update(said.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            if out:
                yield rows(out)
        if state:
            yield rows([state])

    def rows(out):
        done = [(c, n, t.hexdigest(), k, x.hexdigest(), f) for c, n, t, k, x, f in out]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    ordered = formatted.select("conv_id", "segment", "piece", "formatted", "loss_chars").repartition("conv_id").sortWithinPartitions("conv_id", "segment", "piece")
    return ordered.mapInArrow(read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7 (control strings), formatted, stored and read back."""
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digest(stored(format_conversations(turns), "chat"))

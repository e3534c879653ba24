"""Language identification by segmentation-marginalised unigrams.

Each language gives every piece of a fixed public vocabulary a probability. A
word's probability is the sum over all its segmentations into pieces, which
a forward pass computes: a[i] = sum over pieces ending at i of a[start] * p. A
text's log-likelihood is the sum over its words. The probabilities come from
expectation-maximisation on words of labelled rows (forward and backward
passes), on a bounded sample per language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistra.llm.common import process_value, stored, table, texts_of, tokenizer_path

VOCABULARY = "piece_bpe_32k.model"
UNKNOWN = "und"
# Bounds of what the probabilities are fitted on, for each language: rows drawn
# by the hash of their id, and of these the most frequent words.
FIT_ROWS = 1024
DRAWS = 64
FIT_WORDS = 30_000
EM_ROUNDS = 3
SMOOTHING = 0.05
# A letter that is no piece stands alone with this probability in every language.
STRAY = 1e-6
# Longer words go forward one at a time; for the fit they are taken in runs of so many letters.
LONGEST = 40
# Letters of a long word between two scalings of its sums.
SCALE_EVERY = 16
WORD_CACHE = 200_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_START = 0x2581  # marks a word's start in the vocabulary


class Pieces:
    """Lower-case letter pieces of the vocabulary, found by hash."""

    def __init__(self, name: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        names = {model.id_to_piece(i) for i in range(model.get_piece_size())}
        self.names = sorted(p for p in names if p == p.lower() and p.replace(chr(_START), "", 1).isalpha() and chr(_START) not in p[1:])
        self.lengths = sorted({len(p) for p in self.names})
        hashes = np.array([self._hash(p) for p in self.names], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    @staticmethod
    def _hash(piece: str) -> int:
        total, power = 0, 1
        for c in piece:
            total = (total + ord(c) * power) % 2**64
            power = power * int(_BASE) % 2**64
        return total

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)


def pieces_of(name: str) -> Pieces:
    return process_value(("pieces", name), lambda: Pieces(name))


def word_matrix(words: list[str]) -> np.ndarray:
    """One row per word: the word mark, its characters, zeros."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    out = np.zeros((len(words), int(sizes.max()) + 1), dtype=np.uint64)
    out[:, 0] = _START
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.repeat(np.arange(len(words)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    out[row, column] = flat
    return out


def spans(matrix: np.ndarray, pieces: Pieces) -> dict[int, list[tuple[int, int, np.ndarray]]]:
    """By end: (start, length, piece number per row or -1) of all spans that are a piece in some row."""
    width = matrix.shape[1]
    powers = np.ones(width + 1, dtype=np.uint64)
    np.multiply.accumulate(np.full(width, _BASE), out=powers[1:])
    totals = np.zeros((matrix.shape[0], width), dtype=np.uint64)  # hash of the span that starts here
    found: dict[int, list[tuple[int, int, np.ndarray]]] = {i: [] for i in range(1, width + 1)}
    for length in range(1, width + 1):
        room = width - length + 1
        totals = totals[:, :room] + matrix[:, length - 1 :] * powers[length - 1]
        if length in pieces.lengths:
            numbers = pieces.find(totals)
            numbers[matrix[:, length - 1 :] == 0] = -1
            for start in range(room):
                if (numbers[:, start] >= 0).any():
                    found[start + length].append((start, length, numbers[:, start]))
        elif length > pieces.lengths[-1]:
            break
    return found


def _weights(numbers: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probabilities (rows x languages) of pieces; 0 where there is none."""
    return np.where((numbers >= 0)[:, None], table[np.maximum(numbers, 0)], 0.0)


def forward(matrix: np.ndarray, found, table: np.ndarray) -> np.ndarray:
    """a[word, i, language]: summed probability of the first i characters."""
    count, width = matrix.shape
    a = np.zeros((count, width + 1, table.shape[1]))
    a[:, 0] = 1.0
    for end in range(1, width + 1):
        total = a[:, end - 1] * STRAY
        for start, length, numbers in found[end]:
            total = total + a[:, start] * _weights(numbers, table)
        a[:, end] = total
    return a


def word_scores(words: list[str], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """log P(word) for each word and language."""
    out = np.zeros((len(words), table.shape[1]))
    order = np.argsort([len(w) for w in words], kind="stable")
    for at in range(0, len(order), 4000):
        part = order[at : at + 4000]
        matrix = word_matrix([words[i] for i in part])
        a = forward(matrix, spans(matrix, pieces), table)
        ends = (matrix != 0).sum(axis=1)
        out[part] = np.log(np.maximum(a[np.arange(len(part)), ends], 1e-300))
    return out


def long_word_scores(word: str, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """log P(word) for each language, of a word of any length: the same sum over all
    segmentations. As many sums as the longest piece has letters are kept, scaled now and then."""
    letters = np.concatenate([[_START], np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]).astype(np.uint64)
    n, kept = len(letters), pieces.lengths[-1]
    logs = np.zeros(table.shape[1])
    last = np.zeros((kept + 1, table.shape[1]))  # row i % (kept + 1): the first i characters
    last[0] = 1.0
    for begin in range(0, n, 4096):  # pieces that end in this stretch
        a = max(0, begin - kept)
        part = letters[a : begin + 4096]
        total, power, found = np.zeros(len(part), np.uint64), 1, []
        for length in range(1, min(kept, len(part)) + 1):
            total = total[: len(part) - length + 1] + part[length - 1 :] * np.uint64(power)
            power = power * int(_BASE) % 2**64
            if length in pieces.lengths:
                found.append((length, pieces.find(total)))
        for end in range(begin + 1, min(begin + 4096, n) + 1):
            value = last[(end - 1) % (kept + 1)] * STRAY
            for length, numbers in found:
                at = end - length - a
                if at >= 0 and numbers[at] >= 0:
                    value = value + last[(end - length) % (kept + 1)] * table[numbers[at]]
            last[end % (kept + 1)] = value
            if end % SCALE_EVERY == 0:
                logs += np.log(value)
                last /= value
    return logs + np.log(last[n % (kept + 1)])


def expected_counts(words: list[str], weights: np.ndarray, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words (one language)."""
    counts = np.zeros(len(pieces.names))
    order = np.argsort([len(w) for w in words], kind="stable")
    for at in range(0, len(order), 4000):
        part = order[at : at + 4000]
        matrix = word_matrix([words[i] for i in part])
        found = spans(matrix, pieces)
        a = forward(matrix, found, table)[:, :, 0]
        width = matrix.shape[1]
        ends = (matrix != 0).sum(axis=1)
        b = np.zeros((len(part), width + 1))
        b[np.arange(len(part)), ends] = 1.0
        scale = weights[part] / np.maximum(a[np.arange(len(part)), ends], 1e-300)
        for end in range(width, 0, -1):
            inside = end <= ends
            b[:, end - 1] += np.where(inside, b[:, end] * STRAY, 0.0)
            for start, length, numbers in found[end]:
                p = _weights(numbers, table)[:, 0] * b[:, end]
                b[:, start] += p
                counts += np.bincount(np.maximum(numbers, 0), weights=a[:, start] * p * scale * (numbers >= 0), minlength=len(counts))
    return counts


_LETTERS = r"[^\pL]+"


def batch_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct lower-case words, word index of each run of letters in order, first run of each text and an end)."""
    runs = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.string())))
    coded = runs.flatten().dictionary_encode()
    # letters of the distinct runs only; a run may hold several words, or none
    inner = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.replace_substring_regex(coded.dictionary, _LETTERS, " ")))
    words = inner.flatten().dictionary_encode()
    at = inner.offsets.to_numpy() - inner.offsets[0].as_py()
    sizes = np.diff(at)
    indices = coded.indices.to_numpy() if len(coded) else np.zeros(0, np.int64)
    per_run = sizes[indices] if len(indices) else np.zeros(0, np.int64)
    start = np.repeat(at[:-1][indices] if len(indices) else indices, per_run)
    inside = np.arange(len(start)) - np.repeat(np.cumsum(per_run) - per_run, per_run)
    numbers = words.indices.to_numpy()[start + inside] if len(start) else np.zeros(0, np.int64)
    outer = runs.offsets.to_numpy() - runs.offsets[0].as_py()
    names, first = words.dictionary.to_numpy(zero_copy_only=False).tolist(), np.concatenate([[0], np.cumsum(per_run)])[outer]
    if "" in names:  # a run or text without letters
        empty = names.index("")
        real = numbers != empty
        first, numbers = np.concatenate([[0], np.cumsum(real)])[first], numbers[real]
        numbers = numbers - (numbers > empty)
        names.pop(empty)
    return names, numbers, first


def _parts(word: str) -> list[str]:
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def held_out(key: str) -> F.Column:
    """crc32(id as text) mod 5 is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_tables(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text", label: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, probabilities: pieces x languages) from labelled rows that aren't held out.

    Up to FIT_ROWS rows a language: of each of DRAWS classes of a row's hash
    those with the lowest hashes, so that a frequent language is drawn by many
    tasks. One task fits one language on its FIT_WORDS most frequent words.
    """
    drawn = Window.partitionBy("lang", "class").orderBy("hash", "text_hash")
    rows = docs.filter(~held_out(key)).select(
        F.col(label).cast("string").alias("lang"), F.xxhash64(key).alias("hash"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")
    ).filter("lang is not null and _text <> ''")
    # ranks first, on hashes alone: texts of the drawn rows only are moved
    classed = rows.select("lang", "hash", "text_hash", F.pmod(F.xxhash64("text_hash", "hash"), F.lit(DRAWS)).alias("class"))
    ranked = classed.withColumn("rank", F.row_number().over(drawn)).filter(F.col("rank") <= FIT_ROWS // DRAWS)
    chosen = stored(ranked.select("lang", "hash", "text_hash").distinct(), "language-rows")
    sample = rows.join(chosen.hint("broadcast"), ["lang", "hash", "text_hash"]).select("lang", "_text")

    def count(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            names, numbers, first = batch_words(texts_of(batch, "_text"))
            labels = sorted(set(langs))
            number = np.repeat([labels.index(x) for x in langs], np.diff(first))
            pairs, times = np.unique(number * max(1, len(names)) + numbers, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([labels[p // max(1, len(names))] for p in pairs.tolist()]), pa.array([names[p % max(1, len(names))] for p in pairs.tolist()]), pa.array(times)],
                names=["lang", "word", "times"],
            )

    words = sample.mapInArrow(count, "lang string, word string, times bigint").groupBy("lang", "word").agg(F.sum("times").alias("times"))
    top = words.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("times"), "word"))).filter(F.col("rank") <= FIT_WORDS)

    def fit(key, frame):
        import pandas as pd

        pieces = pieces_of(vocabulary)
        frame = frame.sort_values("rank")
        parts = [(p, t) for w, t in zip(frame["word"], frame["times"]) for p in _parts(w)]
        names, weights = [p for p, _ in parts], np.array([t for _, t in parts], dtype=np.float64)
        # shorter pieces are likelier to begin with, or long rare ones would take all
        p = np.array([0.1 ** len(x) for x in pieces.names])
        p /= p.sum()
        for _ in range(EM_ROUNDS):
            counts = expected_counts(names, weights, pieces, p[:, None]) + SMOOTHING
            p = counts / counts.sum()
        return pd.DataFrame({"lang": [key[0]], "probabilities": [p.astype("<f8").tobytes()]})

    found = top.groupBy("lang").applyInPandas(fit, "lang string, probabilities binary").orderBy("lang").collect()  # a row per language
    tables = [np.frombuffer(r["probabilities"], dtype="<f8") for r in found]
    return [r["lang"] for r in found], np.stack(tables, axis=1) if tables else np.zeros((0, 0))


def identify(docs: DataFrame, languages: list[str], probabilities: np.ndarray, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; no shuffle.

    ``score``: the posterior of the language under equal priors; ties go to the
    first in alphabetical order. Null text or no letters, or no language to
    choose from: ``und`` with score 0. Other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast((languages, probabilities))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def predict(batches):
        langs, probs = model.value
        pieces = pieces_of(vocabulary)
        places: dict[str, int] = {}
        known = np.zeros((0, len(langs)))
        for batch in batches:
            names, numbers, first = batch_words(texts_of(batch, "_text"))
            if len(langs):
                if len(places) > WORD_CACHE:
                    places, known = {}, known[:0]
                new = [w for w in names if w not in places]
                if new:
                    short = [w for w in new if len(w) <= LONGEST]
                    new = short + [w for w in new if len(w) > LONGEST]
                    scores = [word_scores(short, pieces, probs)] if short else []
                    known = np.concatenate([known, *scores, *(long_word_scores(w, pieces, probs)[None] for w in new[len(short) :])])
                    for w in new:
                        places[w] = len(places)
                per_word = known[np.array([places[w] for w in names], dtype=np.int64)] if names else known[:0]
                total = np.concatenate([np.zeros((1, len(langs))), np.cumsum(per_word[numbers], axis=0)])
                total = total[first[1:]] - total[first[:-1]]
                best = total.argmax(axis=1)
                chance = 1 / np.exp(np.minimum(total - total.max(axis=1, keepdims=True), 0)).sum(axis=1)
            else:
                best, chance = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            none = (np.diff(first) == 0) | (len(langs) == 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"), batch.column("held_out"),
                    pa.array([UNKNOWN if e else langs[b] for e, b in zip(none.tolist(), best.tolist())]), pa.array(np.where(none, 0.0, chance)),
                ],
                schema=schema,
            )

    source = docs.select(F.col(key).cast("bigint").alias("_key"), held_out(key).alias("held_out"), F.col(text).cast("string").alias("_text"))
    return source.mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, *fit_tables(docs))

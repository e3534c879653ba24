"""Token files, packing, token counts and chat formatting against brute force."""

import hashlib
import random
import string
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import SF, table
from vistra.llm import chat, packing, token_counts, token_files
from vistra.llm.common import WordEncoder
from vistra.session import scratch_path

WORD, BYTE = (Tokenizer.from_file(public_tokenizers.path(f)) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def ids_of(text, end):
    return [*WORD.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_word_encoder_is_the_library(odd_texts):
    rng = random.Random(5)
    pool = ["a", "A", "É", "É", "́", " ", "\n", "\x0b", "\x1c", "\x85", "<|endoftext|>", "'s", "'LL", "1", "½", "İ", "Σ", "ſ", "ß", "中", "!", "..", ",", "​", "\U0001f600", "ŉ", "Ŀ"]
    texts = [t or "" for t in odd_texts] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    encoder = WordEncoder("word_bpe_49k.json")
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == WORD.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5, 5, 9, 2**40], list(range(0, 3000, 3)), [2**62]])
def test_elias_fano_round_trip(values):
    e, end = token_files.EliasFano.read(token_files.EliasFano.encode(np.array(values, dtype=np.int64)).to_bytes(), 0)
    assert e.values().tolist() == values
    assert [e.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        e.select(len(values))


def test_elias_fano_is_smaller_than_a_table():
    bounds = np.cumsum(np.random.default_rng(0).integers(1, 2000, 10_000))
    assert len(token_files.EliasFano.encode(bounds).to_bytes()) < 8 * len(bounds) / 4


def expected_files(rows):
    at, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(text, 2)
        out.append((key, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def test_op2_on_documents(spark):
    got = sorted(tuple(r) for r in token_files.op2_elias_fano_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    docs = table("documents")
    assert got == expected_files(list(zip(docs.doc_id.tolist(), docs.text)))


def test_token_files_odd_rows_and_select(spark, odd_docs):
    path = scratch_path(spark, "t-files")
    token_files.write_token_files(odd_docs, path, "word_bpe_49k.json", 2, files=3)
    rows = token_files.read_token_files(spark, path).collect()
    want = {}
    for r in odd_docs.collect():
        want.setdefault(r.doc_id, []).append(ids_of(r.text, 2))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(np.frombuffer(r.ids, "<u4").tolist())
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for data in (r.content for r in spark.read.format("binaryFile").load(path).collect()):
        for block in token_files.blocks_of(bytes(data)):
            keys = [block.key(i) for i in range(block.documents)]
            assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
            for i, k in enumerate(keys):
                assert block.ids(i).tolist() in want[k]


def test_token_files_of_an_empty_table(spark, odd_docs):
    path = scratch_path(spark, "t-empty")
    token_files.write_token_files(odd_docs.limit(0), path, "word_bpe_49k.json", 2)
    assert token_files.read_token_files(spark, path).count() == 0
    assert token_files.read_block_starts(spark, path).count() == 0


def check_packing(pieces, docs, end, size):
    want = {}
    for key, text in docs:
        want.setdefault(key, []).append(ids_of(text, end))
    got, sequences = {}, {}
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    if all(len(v) == 1 for v in want.values()):
        for key, (ids,) in want.items():
            whole = []
            for start, part in sorted(got[key, len(ids)]):
                assert start == len(whole)
                whole += part
            assert whole == ids
    assert sum(len(i) for v in want.values() for i in v) == sum(r.length for r in pieces)
    assert sorted(sequences) == list(range(len(sequences)))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size


def test_packing_on_documents(spark):
    docs = table("documents")
    pieces = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"), "word_bpe_49k.json", 1).collect()
    check_packing(pieces, list(zip(docs.doc_id.tolist(), docs.text)), 1, 2048)
    used = sum(r.length for r in pieces)
    assert (max(r.sequence_id for r in pieces) + 1) * 2048 < 1.05 * used + 2048


@pytest.mark.parametrize("size", [8, 2048])
def test_packing_odd_rows(spark, odd_docs, size):
    pieces = packing.pack_documents(odd_docs.repartition(3), "word_bpe_49k.json", 1, size=size).collect()
    check_packing(pieces, [(r.doc_id, r.text) for r in odd_docs.collect()], 1, size)


def test_packing_an_empty_table(spark, odd_docs):
    assert packing.pack_documents(odd_docs.limit(0), "word_bpe_49k.json", 1).count() == 0


def test_plans_use_every_length_once_and_stay_small():
    rng = random.Random(2)
    for _ in range(100):
        size = rng.choice([8, 32, 2048])
        histogram = {rng.randint(1, size): rng.randint(1, 90) for _ in range(rng.randint(1, 40))}
        plan, used = packing.plan_patterns(histogram, size), {}
        for count, pattern in plan:
            assert sum(n * m for n, m in pattern) <= size
            for n, m in pattern:
                used[n] = used.get(n, 0) + count * m
        assert used == histogram
        assert len(plan) <= 3 * size


def test_spliced_counts_equal_whole_ones(odd_texts):
    rng = random.Random(7)
    pool = ["a", "b ", " ", "  ", "\n", "\n\n ", "it's", "'ll", "12", "!?", "é", "中文", "<|endoftext|>", "<|endof", "x" * 50, "　"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 900))) for _ in range(150)] + [t for t in odd_texts if t]
    for t in texts:
        for chunk, overlap in ((300, 80), (64, 70), (1000, 100)):
            runs = token_counts.spliced_ids(lambda x: BYTE.encode_batch(x, add_special_tokens=False), t, chunk, overlap)
            assert [i for r in runs for i in r] == BYTE.encode(t, add_special_tokens=False).ids


def test_token_counts(spark, odd_docs):
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        for r in token_counts.token_counts(docs, "byte_bpe_50k.json", chunk=2000).join(docs.select("doc_id", "text"), "doc_id").collect():
            if r.doc_id != 3:
                n = len(BYTE.encode(r.text or "", add_special_tokens=False).ids)
                assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)
    assert token_counts.token_counts(odd_docs, "byte_bpe_50k.json").count() == odd_docs.count()
    assert token_counts.token_counts(odd_docs.limit(0), "byte_bpe_50k.json").count() == 0


def odd_mixes(odd_texts):
    """Texts of all sorts of words, white space and special strings next to each other."""
    rng = random.Random(11)
    pool = ["a", "b ", " c", " ", "  ", "\n", "\n\n ", "\t", "\r\n", "it's", "'ll", "'", "'s,'", "12", "½", "!?", "$$$ ", " (x", "é", "e\u0301,", "中文", "。", "İ", "Жя,", "x" * 50]
    pool += ["\x00", "\x0b", "\x1c", "\x1f.", "\x85", "\xa0", "\u180e", "\u2003", "\u2028", "\u200b", "\u3000", "\ufeff", "Ġ", "Ċ", "\U0001f600"]
    rare = ["\x01", "<|endoftext|>", "<|endof"]
    mixes = ["".join(rng.choice(pool + rare * (i % 3 == 0)) for _ in range(rng.randint(1, 60))) for i in range(4000)]
    return [t or "" for t in odd_texts] + mixes


def test_pieces_count_as_the_whole_text(odd_texts):
    texts = odd_mixes(odd_texts)
    counter = token_counts.PieceCounter("byte_bpe_50k.json")
    assert counter.cuts
    want = [len(e) for e in BYTE.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time all short pieces are known
        assert token_counts.count_tokens(pa.array([*texts, None], pa.string()), counter).tolist() == [*want, 0]
    joined = ["".join(texts[i : i + 40]) for i in range(0, len(texts), 40)] + ["中文。" * 3000, "z" * 3000]
    want = [len(e) for e in BYTE.encode_batch(joined, add_special_tokens=False)]
    for chunk, overlap in ((300, 80), (64, 70), (1000, 100)):
        assert token_counts.count_tokens(pa.array(joined), counter, chunk, overlap).tolist() == want
    other = token_counts.PieceCounter("word_bpe_49k.json")
    assert not other.cuts
    assert token_counts.count_tokens(pa.array(texts), other).tolist() == [len(e) for e in WORD.encode_batch(texts, add_special_tokens=False)]


def test_white_space_of_the_cuts_is_the_tokenizers():
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    column = pa.array(every)
    found = pc.filter(column, pc.match_substring_regex(column, f"[ {token_counts._LINE}]")).to_pylist()
    assert found == [c for c in every if len(BYTE.pre_tokenizer.pre_tokenize_str(c + c + "\n")) == 1]
    letters = pc.filter(column, pc.match_substring_regex(column, token_counts._LETTER)).to_pylist()
    assert all(len(BYTE.pre_tokenizer.pre_tokenize_str(c + p)) == 2 for c in letters for p in string.punctuation)


def test_recurring_pieces_are_encoded_once_and_few_are_kept(monkeypatch):
    counter = token_counts.PieceCounter("byte_bpe_50k.json")
    calls = []
    learn = counter._learn
    monkeypatch.setattr(counter, "_learn", lambda pieces: calls.extend(pieces) or learn(pieces))
    monkeypatch.setattr(token_counts, "WORD_CACHE", 200)
    texts = [f"the same words, and the same. word{i} x{'y' * 60}{i}" for i in range(300)]
    for t in texts:
        assert token_counts.count_tokens(pa.array([t]), counter).tolist() == [len(BYTE.encode(t).ids)]
        assert len(counter.known) + len(counter.older) <= 220
        assert max(map(len, [*counter.known, *counter.older])) <= 40
    assert calls.count(" same") == 1 and calls.count(" words") == 1 and len(calls) < 1000


def expected_chat(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: [(x is not None, x if x is not None else 0) for x in t[1:2]] + [(x is not None, x or "") for x in t[2:]])
        own = [(r or "", x or "") for _, _, r, x in own]
        loss = "".join(x for r, x in own if r == "assistant")
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
        out[conv] = (len(own), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(own)[0]))
    return out


def test_op10_on_conversations(spark):
    c = table("conversations")
    turns = list(zip(c.conv_id.tolist(), c.turn.tolist(), c.role, c.text)) + [(-7, 0, "user", chat.CONTROL_TEXT), (-7, 1, "assistant", chat.CONTROL_TEXT)]
    got = {r[0]: tuple(r)[1:] for r in chat.op10_chat_format(spark, SF).collect()}
    assert got == expected_chat(turns)


@pytest.mark.parametrize("segment", [2, 256])
def test_chat_odd_rows(spark, odd_texts, segment):
    markers = ["<|turn|>", "<|say|>assistant<|end|>\n", "\\", "\\l<", "", None, "  lead", "\n\n", "ends in space ", "\U0001f600中"]
    turns = [(i % 3, i, r, t) for i, (r, t) in enumerate((r, t) for t in markers + odd_texts for r in ("assistant", "user", "we<|ird|>", None))]
    turns += [(9, 1, "assistant", "same"), (9, 1, "assistant", "same"), (9, None, "user", "no turn"), (None, 4, "assistant", "null conv"), (9, -5, "system", "negative")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id bigint, turn bigint, role string, text string, formatted string")
    out = chat.format_conversations(df, segment_turns=segment)
    assert {r[0]: tuple(r)[1:] for r in chat.digest(out).collect()} == expected_chat(turns)
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0


def test_masked_tokens_cover_spans():
    text, spans = chat.render([("assistant", "héllo 中文 \U0001f600!"), ("user", "x"), ("assistant", " <b> \\ ")])
    e = chat.chat_tokenizer("byte_bpe_50k.json").encode(text, add_special_tokens=False)
    offsets = np.array(e.offsets)
    for (a, b), (s, t) in zip(chat.masked_tokens(offsets, np.array(spans)), spans):
        assert offsets[a, 0] == s and offsets[b - 1, 1] == t


def test_select_of_many_places():
    import numpy as np

    from vistra.llm.token_files import EliasFano

    rng = np.random.default_rng(3)
    for values in ([], [0], [5, 5, 5], np.cumsum(rng.integers(0, 9, 3000)), np.cumsum(rng.integers(0, 2, 700) * 50_000), [0, 1, 2, 10**6, 10**12]):
        ef = EliasFano.encode(np.array(values, np.int64))
        places = rng.permutation(len(values))
        assert ef.select_all(places).tolist() == [int(values[i]) for i in places] == [ef.select(int(i)) for i in places]


def test_number_of_files_follows_the_input(spark, tmp_path_factory, monkeypatch):
    from vistra.llm import token_files
    from vistra.session import scratch_path

    docs = spark.createDataFrame([(i, "some words " * 50) for i in range(200)], "doc_id bigint, text string")
    assert token_files._text_bytes(docs, "text") > 0
    monkeypatch.setattr(token_files, "FILE_BYTES", 500)
    path = scratch_path(spark, "files")
    docs.write.parquet(path + "-docs")
    token_files.write_token_files(spark.read.parquet(path + "-docs"), path, "word_bpe_49k.json", end_id=2)
    files = -(-token_files._text_bytes(spark.read.parquet(path + "-docs"), "text") // 500)
    assert files > 8  # more than the shuffle setting
    assert 8 < spark.read.format("binaryFile").load(path).filter("length > 0").count() <= files


def test_text_groups_hold_all_texts_in_order(odd_texts):
    import pyarrow as pa

    from vistra.llm.common import text_groups

    column = pa.array(odd_texts * 3, pa.string())
    for batch in (pa.RecordBatch.from_arrays([column], names=["text"]), pa.RecordBatch.from_arrays([column], names=["text"]).slice(5, 20)):
        want = [t or "" for t in batch.column("text").to_pylist()]
        for size in (1, 100, 10_000, 1 << 30):
            groups = list(text_groups(batch, size=size))
            assert [t for _, g in groups for t in g] == want
            assert [a for a, _ in groups] == np.cumsum([0] + [len(g) for _, g in groups])[:-1].tolist()
            assert all(g and sum(len(t.encode()) for t in g[:-1]) < size for _, g in groups)
    assert list(text_groups(pa.RecordBatch.from_arrays([column[:0]], names=["text"]))) == []


def test_word_encoder_takes_a_column(odd_texts, monkeypatch):
    import pyarrow as pa

    from vistra.llm import common

    monkeypatch.setattr(common, "LEARN_WORDS", 2)
    column = pa.array(["cut off", *odd_texts, None], pa.string())[1:]
    whole = WordEncoder("word_bpe_49k.json").encode([t or "" for t in odd_texts] + [""])
    assert WordEncoder("word_bpe_49k.json").encode(column) == whole


def learned_by(encoder):
    """What the encoder gives to the library from now on: plain words, other runs."""
    seen = {}
    for name in ("_plain", "_other"):
        own, seen[name] = getattr(encoder, name), []
        setattr(encoder, name, lambda words, own=own, held=seen[name]: held.extend(words) or own(words))
    return seen["_plain"], seen["_other"]


def test_words_with_punctuation_go_as_word_and_tail():
    encoder = WordEncoder("word_bpe_49k.json")
    plain, other = learned_by(encoder)
    tails = ["", ".", "$$$", ",***", "!?", "'", "\"'", "<|", "|>", "_-"]
    runs = [w + t for w in ("Word", "éan", "ŉ", "S", "endoftext") for t in tails]
    for ids, run in zip(encoder.encode([" ".join(runs), *runs])[1:], runs, strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == WORD.encode(run, add_special_tokens=False).ids, run
    assert sorted(plain) == sorted(["word", "éan", "ŉ", "s", "endoftext"])
    assert sorted(other) == sorted(tails[1:])


def test_words_of_many_batches_stay_known(monkeypatch):
    from vistra.llm import common

    monkeypatch.setattr(common, "WORD_CACHE", 40)
    rng = random.Random(1)
    once = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(600)]
    often = ["alpha", "beta", "gamma", "1st", "x" * 100]
    encoder = WordEncoder("word_bpe_49k.json")
    plain, other = learned_by(encoder)
    for i in range(0, 600, 10):
        texts = [" ".join(often[i // 10 % 2 :: 2] + once[i : i + 10]), ""]  # each in every second batch
        want = [WORD.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == want
    assert [plain.count(w) for w in often[:3]] == [1, 1, 1] and other.count("1st") == 1
    assert len(encoder.words) == len(encoder.ids) == len(encoder.uses) <= 40 and "x" * 100 not in encoder.words.to_pylist()

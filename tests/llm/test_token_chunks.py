"""Texts above the chunk size are counted chunk by chunk, at any chunk size, as the library counts them whole."""

import random

import public_tokenizers
import sentencepiece

from vaultweave.llm import token_count

FILE = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    draw = random.Random(3)
    letters = "aeinrstoé漢😀▁ \n\t.,0129"
    out = ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 400))) for _ in range(120)]
    out += ["x" * 700, "ab" * 300, "the" * 200 + " end", " " * 90, "a" + " " * 90 + "b", "internationalization" * 30, "1234567890" * 50]
    return out + out[:20] + [None, ""]


def test_chunks_of_any_size(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=FILE)
    rows = list(enumerate(odd_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = {i: (len((t or "").encode()), len(lib.encode(t or ""))) for i, t in rows}
    for size in (5, 64):
        got = token_count.token_counts(docs, FILE, chunk_chars=size).collect()
        assert len(got) == len(rows) and {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want


def test_entries_foretold_wrongly_are_run_again(spark):
    texts = ["x" * 200, "internationalization" * 8, "ab cd " * 20]
    lib = sentencepiece.SentencePieceProcessor(model_file=FILE)
    c = token_count.counter(FILE)
    right = []
    for t in texts:
        state = token_count.START
        for before, chunk in token_count.chunks(t, 40, 1):
            right.append(token_count._starts(before, chunk) or c.foretold(before, chunk) == state)
            state, _ = c.through(chunk, token_count.START if token_count._starts(before, chunk) else state)
    assert not all(right)  # one character before a chunk foretells little
    long = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, text string")
    got = {r.key: r.n_tokens for r in token_count.long_counts(long, FILE, 40, look_back=1).collect()}
    assert got == {str(i): len(lib.encode(t)) for i, t in enumerate(texts)}


def test_text_without_spaces_is_more_than_one_map(spark):
    text = "".join(random.Random(1).choice("etaoinshrdlu") for _ in range(400_000))
    docs = spark.createDataFrame([(1, text), (2, text), (None, text + "x")], "doc_id long, text string")
    lib = sentencepiece.SentencePieceProcessor(model_file=FILE)
    assert len(list(token_count.chunks(text, token_count.CHUNK_CHARS))) == 7
    got = {r.doc_id: r.n_tokens for r in token_count.token_counts(docs, FILE).collect()}
    assert got == {1: len(lib.encode(text)), 2: len(lib.encode(text)), None: len(lib.encode(text + "x"))}


def test_states_survive_writing():
    for state in (token_count.START, ((5, -1, 0), (9, 3, -1), (0, 3, 0))):
        assert token_count._read(token_count._written(state)) == state

"""Token counts and the piece codec against the libraries themselves."""

import hashlib

import public_tokenizers
import pytest
from seriesmill.llm import piece_codec, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b   c ", "▁a▁▁b", "\n", "word.\nnext\tcol", "nul\x00 in", "ﬁ é ½ 漢字 🎉🎉 ok", "<s>x</s> <unk> <0x41>",
    "x" * 3000, "ab " * 4000, " " * 500, "　x y", "Größe über Señor ça",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "l", i) for i, t in enumerate(texts)], "doc_id long, text string, ids string, table int")


def test_codec_is_the_library(spark):
    library = piece_codec.processor(MODEL)
    rows = {r.doc_id: r for r in piece_codec.round_trip_digests(frame(spark, TEXTS), MODEL).collect()}
    assert len(rows) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_eos=True)
        assert rows[i].n_tokens == len(ids), t
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_codec_on_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    library = piece_codec.processor(MODEL)
    out = piece_codec.decode(piece_codec.encode(docs.select("doc_id", "text"), MODEL), MODEL)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        ids = library.encode(texts[r.doc_id], add_eos=True)
        assert r.ids == ids and r.text == library.decode(ids)


@pytest.mark.parametrize("most", [3, 50, 10**6])
def test_a_full_table_changes_nothing(most):
    """Chunks that one slice only has met are forgotten first; ids are the library's whatever is remembered."""
    import random

    rng, library = random.Random(most), piece_codec.processor(MODEL)
    table = piece_codec.ChunkTable(MODEL)
    table.table.most = most
    for _ in range(30):
        texts = [" ".join(rng.choice(["the", "word", "", "x" * 80, f"n{rng.randint(0, 60)}", "é漢\n"]) for _ in range(rng.randint(0, 30))) for _ in range(8)]
        ids, lengths = table.encode(texts, [library.eos_id()])
        ends = lengths.cumsum()
        for t, lo, hi in zip(texts, ends - lengths, ends):
            assert ids[lo:hi].tolist() == library.encode(t, add_eos=True), t
        assert len(table.table.table) <= max(most, 1)


def test_slices_are_bounded_and_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(piece_codec, "SLICE", 3)
    monkeypatch.setattr(piece_codec, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["aaaa", "bbbb", None, "c" * 50, "", "d", "e", "f", "g" * 11]})
    got = [b.column(0).to_pylist() for b in piece_codec.slices(batch, 0)]
    assert [x for b in got for x in b] == batch.column(0).to_pylist() and ["c" * 50] in got and max(map(len, got)) == 3


def test_null_lists_and_clashing_columns(spark):
    tokens = spark.createDataFrame([(1, None), (2, []), (3, [450, None, 2])], "doc_id long, ids array<int>")
    assert [r.text for r in piece_codec.decode(tokens, MODEL).orderBy("doc_id").collect()] == ["", "", piece_codec.processor(MODEL).decode([450, 2])]
    with pytest.raises(ValueError):
        piece_codec.encode(frame(spark, ["a"]), MODEL)
    with pytest.raises(ValueError):
        piece_codec.decode(tokens.withColumnRenamed("doc_id", "text"), MODEL)
    assert piece_codec.encode(frame(spark, ["a"]), MODEL, ids="pieces").columns == ["doc_id", "pieces", "ids", "table"]


def test_empty_table(spark):
    assert piece_codec.round_trip_digests(frame(spark, []), MODEL).count() == 0
    assert token_counts.count_tokens(frame(spark, []), MODEL).count() == 0


def unigram(pieces, **more):
    from tokenizers import Tokenizer, models

    return Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, **more))


def test_counts_are_the_unigram_tokenizer(spark):
    pieces, has_bytes = token_counts.vocabulary(MODEL)
    assert has_bytes
    library = piece_codec.processor(MODEL)
    from tokenizers import Tokenizer, models

    vocabulary = [("<unk>", 0.0), *((library.id_to_piece(i), -2e9) for i in range(3, 259)), *pieces]
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = [t for t in [*TEXTS, *docs] if "<0x" not in (t or "")]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, texts), MODEL).collect()}
    for i, t in enumerate(texts):
        marked = "▁" + t.replace(" ", "▁") if t else ""
        assert got[i] == len(tokenizer.encode(marked).tokens), t


@pytest.mark.parametrize("seed", range(5))
def test_tie_rules(seed):
    import random

    rng = random.Random(seed)
    pieces = {"".join(rng.choices("abc", k=rng.randint(1, 4))): -float(rng.randint(1, 4)) for _ in range(25)}
    tokenizer = unigram(pieces.items())
    counter = token_counts.PieceCounter(pieces.items(), False)
    for _ in range(300):
        text = "".join(rng.choices("abcd", k=rng.randint(1, 12)))
        assert counter.of_chunk(text) == len(tokenizer.encode(text).tokens), (text, pieces)


@pytest.mark.parametrize("seed", range(60))
def test_ties_of_fractional_scores_are_those_of_the_whole_text(seed):
    """Rounded sums of scores depend on the text before a chunk: 60 vocabularies with one decimal place, 60 texts each."""
    import random

    rng = random.Random(seed)
    pieces = {"▁": -1.5} | {rng.choice(["", "▁"]) + "".join(rng.choices("abc", k=rng.randint(1, 4))): -rng.randint(10, 40) / 10 for _ in range(40)}
    tokenizer, counter = unigram(pieces.items()), token_counts.PieceCounter(pieces.items(), False)
    texts = [" ".join("".join(rng.choices("abcd", weights=(9, 9, 9, 1), k=rng.randint(1, 9))) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    wanted = [len(tokenizer.encode("▁" + t.replace(" ", "▁")).tokens) for t in texts]
    assert counter.of_texts(texts).tolist() == wanted
    assert counter.of_texts([]).tolist() == []

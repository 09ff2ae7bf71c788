"""BPE (1) and token counts (10) against the public tokenizers library."""

import public_tokenizers
import pytest
import tokenizers

from sievemark.llm import bpe, token_count

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
TEXTS = [
    None, "", "   ", "a  b \n\n c  ", "<|startoftext|>Hi <|endoftext|> there<|endoftext|>", "ΑΣ ΟΔΟΣ Σ", "İstanbul ǅ ½ ² x²",
    "日本語テキスト", "é ̀a", "it's I'LL don't 123abc", "a\x1cb\x1f c", "😀😀 🎉" + "é" * 300, "x" * 5000, "-=" * 200,
    "tab\tnew\r\nline nbsp　x", "\n\n", " \n a", "<|endoftext|>", "a<|endoftext|>  <|startoftext|>",
    "The quick brown fox jumps over the lazy dog. " * 3000, "Voilà l'été; l'été",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "kept") for k, t in enumerate(TEXTS)] + [(1, "twice", "kept")] * 2 + [(None, "no id", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, extra string").cache()


@pytest.mark.parametrize("file", FILES)
def test_ids_and_text_match_the_library(docs, file):
    path = public_tokenizers.path(file)
    library = tokenizers.Tokenizer.from_file(path)
    encoded = bpe.encode(docs.withColumnRenamed("extra", "ids"), path)  # a clashing column is replaced
    assert encoded.columns == ["doc_id", "text", "ids"]
    rows = bpe.decode(encoded, path).collect()
    assert len(rows) == len(TEXTS) + 3
    for row in rows:
        want = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == want
        assert row["decoded"] == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("file", FILES)
def test_counts_match_the_library(docs, file):
    path = public_tokenizers.path(file)
    library = tokenizers.Tokenizer.from_file(path)
    for row in token_count.count_tokens(docs, path).collect():
        assert row["n_tokens"] == len(library.encode(row["text"] or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("file", FILES)
def test_whole_tokens_are_those_the_library_leaves_whole(file):
    path = public_tokenizers.path(file)
    model = bpe.Bpe.load(path)
    whole = token_count.whole_tokens(model)
    for word in [b"the", b" the", b"qzx", b"ing", b" of", b"!"]:
        assert (len(model.merge([word])[0]) == 1) == (word in whole)
    assert len(whole) > 30_000


def test_long_pretokens_merge_like_short_ones():
    model = bpe.Bpe.load(public_tokenizers.path(FILES[1]))
    for word in (b"interestingly", b"aaaaaaaaaaaaaaaa", b"thethethe"):
        parts = [*model.first[list(word[:-1])].tolist(), int(model.last[word[-1]])]
        assert model._merge_long(parts).tolist() == model.merge([word])[0].tolist()


def test_decode_stands_nulls_and_unknown_ids(spark):
    rows = spark.createDataFrame([([320, None, 99_999_999],), (None,), ([],)], "ids array<int>")
    path = public_tokenizers.path(FILES[0])
    token = bpe.Bpe.load(path).tokens[320]
    assert sorted(r["decoded"] for r in bpe.decode(rows, path).collect()) == ["", "", token]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    path = public_tokenizers.path(FILES[0])
    assert bpe.round_trip(empty, path).collect() == []
    assert token_count.count_tokens(empty, path).collect() == []

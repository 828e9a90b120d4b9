import random

import public_tokenizers as P
import pytest

from tierload.llm import tokens as K

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def test_pieces_equal_the_library_on_random_texts(library):
    with open(PATH, "rb") as f:
        count = K.counter("x.json", f.read())
    r = random.Random(3)
    parts = [*"ab1 9.,;!'s\n\t\r<|>é 中ŀ😀  ", "\u0085", " ", "<|endoftext|>", " <|endoftext|> ", "'ll", "word", " word"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 16))) for _ in range(8000)]
    assert count(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]
    for t in texts[:2000]:
        pieces = list(K.long_pieces(t, 4))
        assert "".join(pieces) == t
        assert sum(len(library.encode(p, add_special_tokens=False)) for p in pieces) == count([t])[0]


def test_table_and_edges(spark, documents, edge, library):
    for df in (documents, edge, edge.limit(0)):
        got = sorted(map(tuple, K.token_counts(df, PATH).collect()), key=repr)
        want = sorted(((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False)))
                       for r in df.select("doc_id", "text").collect()), key=repr)
        assert got == want


def test_sentencepiece(spark, edge):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted((r.doc_id, r.n_tokens) for r in K.token_counts(edge.where("doc_id < 5"), path).collect())
    assert got == sorted((r.doc_id, len(model.encode(r.text or ""))) for r in edge.where("doc_id < 5").collect())

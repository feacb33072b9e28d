import zlib
from collections import defaultdict

import numpy as np
import pytest

from campaignlake.llm import packing
from campaignlake.llm.queries import tokenizer_path

from .tables import DOCS, docs_frame


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_word_encoder_equals_tokenizer(tokenizer):
    encoder = packing.WordEncoder(tokenizer_path(), "<u2")
    for text in ["", " ", "  ", "a  b", "a   b", " a", "a ", "a\n b", "a \nb", "a  \n b", "it's 12 tests' <|endoftext|> x",
                 "\xa0x y　z", "naïve Straße, été!!! ñ.. 你好 世界,, 1a2 a_b ...", "\t a\tb  c\n\n d", "x\x00y z", " word,",
                 "don't, 'tis we'll' ²³ x² ⅷ ª º كتاب́ éé", "a" * 5000, "x,,,, y.!? z|"]:
        assert np.frombuffer(encoder.text(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_word_encoder_generations(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    encoder = packing.WordEncoder(tokenizer_path(), "<u2")
    text = " ".join(f"abc{i % 17} déf, gh" for i in range(200))
    assert np.frombuffer(encoder.text(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_and_sequences(spark, tokenizer):
    docs = docs_frame(spark)
    tokens = packing.tokenize(docs, tokenizer_path())
    pieces = packing.pack(tokens, length=64)
    rows = pieces.collect()
    truth = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        truth[r["doc_id"]].append(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1])
    covered, at = defaultdict(int), defaultdict(list)
    for r in rows:
        ids = truth[r["doc_id"]][0]
        part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids)
        covered[r["doc_id"]] += r["length"]
        at[r["sequence_id"]].append((r["offset"], r["length"], part.tolist()))
    assert all(covered[k] == len(v[0]) * len(v) for k, v in truth.items())
    total = sum(covered.values())
    assert sorted(at) == list(range(-(-total // 64)))
    whole = {r["sequence_id"]: r for r in packing.sequences(pieces, length=64).collect()}
    assert sorted(whole) == sorted(at)
    for k, parts in at.items():
        end, ids = 0, []
        for offset, n, part in sorted(parts):
            assert offset == end
            end += n
            ids += part
        n = whole[k]["n_tokens"]
        got = np.frombuffer(whole[k]["ids"], "<u2").tolist()
        assert n == end and got[:n] == ids and got[n:] == [0] * (len(got) - n)
        assert len(got) == (n if n & (n - 1) == 0 else 64)
    assert [whole[k]["n_tokens"] for k in sorted(whole)][:-1] == [64] * (len(whole) - 1)


def test_empty_table(spark):
    assert packing.pack(packing.tokenize(spark.createDataFrame([], DOCS), tokenizer_path())).count() == 0

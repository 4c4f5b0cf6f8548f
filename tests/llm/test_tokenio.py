import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rhapsode.llm.tokenio import PerfectHash, ShardReader, WordEncoder, hash_keys, read_tokens, tokenizer_path, write_tokens

from .helpers import documents, odd_documents


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


def check(docs):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = [], 0
    for (d, _), ids in zip(rows, whole([t for _, t in rows]), strict=True):
        ids = [*ids, 2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    manifest = write_tokens(docs, tokenizer_path(), shards=3)
    got = sorted((tuple(r) for r in read_tokens(manifest).collect()), key=lambda r: r[1])
    assert got == want
    return manifest, {d: t for d, t in reversed(rows)}


def test_round_trip(spark):
    manifest, texts = check(documents(spark))
    path = manifest.first()["path"]
    r = ShardReader(path)
    for k in r.keys[:20]:
        assert r.get(k).tolist() == [*whole([texts[k]])[0], 2]
    assert r.get(-5) is None and r.get("no such key") is None


def test_odd_rows(spark):
    check(odd_documents(spark))
    empty = write_tokens(odd_documents(spark).limit(0), tokenizer_path())
    assert empty.count() == 0 and read_tokens(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85  'sʼ̈́ΣσİK<|endoftext|>0a.")), max_size=60), max_size=4))
def test_words_give_the_ids_of_whole_texts(texts):
    assert [x.tolist() for x in WordEncoder(tokenizer_path())(texts)] == whole(texts)


def test_special_tokens_inside_texts():
    texts = ["a <|endoftext|> b", "a<|endoftext|>b <|startoftext|>", "x\t́y Σίσυφος ΣΑΣ"]
    assert [x.tolist() for x in WordEncoder(tokenizer_path())(texts)] == whole(texts)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = hash_keys(list(range(n)))
    mph = PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([7, 7], dtype=np.uint64))


def test_shards_go_where_they_are_told(spark, tmp_path):
    manifest = write_tokens(documents(spark).limit(20), tokenizer_path(), path=f"{tmp_path}/shards", shards=2)
    assert all(r["path"].startswith(f"file://{tmp_path}/shards/") for r in manifest.collect()) and read_tokens(manifest).count() == 20

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from answerloom.llm import bpe


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load(bpe._rank_file(None)), public_tokenizers.PATTERN)


def encoded(encoder, texts):
    ids, counts = encoder.encode(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_ids_of_random_texts(encoder, reference):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab \n\té日1!'s\U0001f600") for _ in range(rng.randint(0, 300))) for _ in range(500)]
    assert encoded(encoder, texts) == [reference.encode_ordinary(t) for t in texts]


def test_ids_around_the_matrix_limit(encoder, reference):
    rng = random.Random(6)
    texts = ["a" * n for n in (1, 255, 256, 257, 4000)] + ["".join(rng.choice("abcth") for _ in range(n)) for n in (256, 257, 3000)]
    assert encoded(encoder, texts) == [reference.encode_ordinary(t) for t in texts]


def test_kept_pieces_are_dropped_when_many(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    for text in ("some words here", "other words there", "some words here"):
        assert encoded(encoder, [text]) == [reference.encode_ordinary(text)]


def test_documents_round_trip(documents, rows, reference):
    found = bpe.decode(bpe.encode(documents)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, bpe.encode(documents, decoded=True).collect()), key=str)
    assert found[0].__fields__ == ["doc_id", "n_tokens", "ids", "decoded"]
    got = Counter((x.doc_id, x.n_tokens, hashlib.sha256(x.ids).hexdigest(), bytes(x.decoded)) for x in found)
    ids = [reference.encode_ordinary(t or "") for _, t, _ in rows]
    assert got == Counter(
        (i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), (t or "").encode()) for (i, t, _), x in zip(rows, ids, strict=True)
    )


def test_empty_table(nothing):
    assert bpe.decode(bpe.encode(nothing)).collect() == []

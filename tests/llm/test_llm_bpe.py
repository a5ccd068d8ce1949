import random

import pyarrow as pa
import pytest
from llm_tables import by_id, documents

from skytally.llm import bpe
from skytally.llm.common import arrow_map

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_random_texts_encode_as_the_library_does(encoder, library):
    rng = random.Random(3)
    letters = "aaaabcde  \n\n\t'stre.,!?0123éñ漢🙂\x1c\x85\u00a0\u200b"
    vocabulary = list(encoder.token_bytes.values())
    for n in range(6000):
        if n % 2:
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        else:
            text = b"".join(rng.choice(vocabulary) for _ in range(4)).decode("utf-8", "replace")
        if n % 50 == 0:
            text += "<|endoftext|>" * rng.randint(1, 3) + text
        ids = encoder.encode(text)
        assert list(ids) == ids_of(library, text), text
        assert encoder.decode(ids) == text == library.decode(list(ids), skip_special_tokens=False)


def test_every_token_that_can_occur_encodes_to_itself(encoder, library):
    for token, data in encoder.token_bytes.items():
        if token % 37 == 0 and b"\xff" not in data:
            text = data.decode("utf-8", "replace")
            assert list(encoder.encode(text)) == ids_of(library, text)


def test_tables(spark, encoder, library):
    rows = [(1, "plain text"), (2, None), (3, ""), (4, "a" * 60000 + " " * 5000 + "b"), (5, "é🙂"), (5, "é🙂"), (None, "x")]
    docs = documents(spark, rows)
    encoded = bpe.encode_texts(docs, encoder)
    assert sorted(map(repr, ((r.doc_id, r.ids) for r in encoded.collect()))) == sorted(
        map(repr, ((i, ids_of(library, t or "")) for i, t in rows))
    )
    back = [r.text for r in bpe.decode_ids(encoded, encoder).collect()]
    assert sorted(back) == sorted(t or "" for _, t in rows)
    digests = by_id(bpe.encoded_digests(docs, encoder))
    assert digests[2].ids_sha256 == digests[3].ids_sha256 and digests[2].n_tokens == 0
    assert bpe.encode_texts(documents(spark, []), encoder).count() == 0


def test_memory_of_pieces_is_bounded(encoder):
    encoder.memo.most, kept = 50, encoder.memo.most
    encoder.encode(" ".join(str(n) for n in range(1000)))
    assert len(encoder.memo) <= 50 and len(encoder.memo.older) <= 50
    encoder.memo.most = kept


def test_workers_forget_the_encoder_when_they_turn_to_other_work(spark, encoder):
    def encoders(batches):
        import gc

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(type(o).__name__ == "Encoder" for o in gc.get_objects())]})

    docs = spark.range(64, numPartitions=8).selectExpr("id as doc_id", "'some text' as text")
    assert bpe.encode_texts(docs, encoder).count() == 64
    assert {r.n for r in arrow_map(docs, encoders, "n long").collect()} == {0}

import zlib

import numpy as np
import public_tokenizers
import pytest

from sampletide.llm import tokens
from sampletide.session import scratch

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("text", [
    "", "A.B c..d", "I'm we'll can't O'REILLY's x", "Straße ÀÉ İstanbul ǅ ß ﬁ", "é é ́ ok", "a\tb\x0bc\x85d\xa0e f\x1cg",
    "<|endoftext|> x <|STARTOFTEXT|>", "1234 a1b2 ½ x² ªº", "...!!! ?. a?. b!,", "日本語 текст Ελλάς ΣΑΣ", "K Å", "x" * 5000 + " " + "\n\n \n", "a.\nb,\nc", "été, où."])
def test_pieces_encode_as_whole_texts(text):
    encode = tokens.encoder(PATH)
    assert encode(text).tolist() == [*encode.tokenizer.encode(text, add_special_tokens=False).ids, tokens.END]


def plain(rows):
    encode, start, out = tokens.encoder(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_over_rows_batches_and_files(documents, kept_table, spark):
    rows = [(i * 7 % 1000, ("the cat sat on " * (i % 90)).strip() or None) for i in range(1000)]
    for length, files in ((64, 5), (16, 1)):
        out = scratch(spark, "test-ids")
        manifest = kept_table(tokens.write(documents(rows).repartition(7), out, PATH, kept_table, length=length, files=files), "test-manifest")
        got = sorted(map(tuple, tokens.read(manifest).collect()))
        assert got == sorted(plain(rows))
        for r in manifest.collect():
            batch = tokens.sequences(r.file, 0)
            ids = batch.column("ids")
            assert ids.type.list_size == length
            third = ids.slice(2, 1).flatten().to_numpy(zero_copy_only=True)  # a view of the map
            assert len(third) == length
            assert batch.column("mask").slice(0, 1).flatten().to_pylist() == [True] * length


def test_odd_rows(odd, no_documents, kept_table, spark):
    manifest = tokens.write(odd, scratch(spark, "test-ids"), PATH, kept_table)
    got = sorted(tokens.read(manifest).collect(), key=lambda r: r.start)
    want = plain([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(r.n_tokens for r in got) == sorted(w[2] for w in want)
    assert [r.doc_id for r in got] == [w[0] for w in want]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert tokens.read(tokens.write(no_documents, scratch(spark, "test-ids"), PATH, kept_table)).count() == 0


def test_a_repeated_task_replaces_its_file(documents, kept_table, spark):
    out, docs = scratch(spark, "test-ids"), documents([(i, "again and again") for i in range(20)])
    for _ in range(2):
        manifest = tokens.write(docs, out, PATH, kept_table, files=2)
        assert tokens.read(manifest).count() == 20
    import os
    assert sorted(os.listdir(out)) == sorted(r.file.rsplit("/", 1)[1] for r in manifest.collect())

"""Token ids and files against the library's own whole-text ids."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskloom.llm.queries import op5_token_files, vocabulary
from riskloom.llm.token_files import SequenceReader, read_documents, write_sequences
from riskloom.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \n b", "a\tb c", "it's we'll 'tis", "x<|endoftext|> y z<|",
       "<|endoftext|>", " a b", "a\x1cb c", "ÉTÉ Σίσυφος ΣΑΣ, İx", "été ok", "a.\nThe end...\n", "漢字 かな, ok!",
       "1 22 333,4", "don't\nstop", "Word%%% ###", "x" * 100_000, "a\r\nb", "\n", "\na", "🙂 🙂🙂, a", "　a b", "a_b c_"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_whole_text(spark, name):
    whole = Tokenizer.from_file(vocabulary(name))
    own = Encoder(vocabulary(name))
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for t in texts + [" ".join(ODD), "\n".join(ODD), texts[-1].replace(" ", "  ")]:
        assert own.ids(t).tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t[:60])


def _brute(docs):
    whole, at, out = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), 0, {}
    for doc_id, text in sorted(docs):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        out[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    return out


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op5_token_files(spark, SF).collect()}
    assert got == _brute(docs)


def test_edge_rows_and_random_access(spark):
    docs = [(i, t) for i, t in enumerate([None, *ODD])]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, start int")
    manifest = write_sequences(df, vocabulary("byte_bpe_50k.json"), length=64)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read_documents(manifest, 64).collect()}
    assert got == _brute(docs)
    for f in manifest.collect():
        r, n = SequenceReader(f.ids_file), 0
        for k in range(f.n_sequences):
            ids, mask = r.sequence(k)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
            n += int(mask.sum())
        assert n == f.n_ids
        r.close()
    assert read_documents(write_sequences(df.limit(0), vocabulary("byte_bpe_50k.json"))).count() == 0


def test_a_part_with_punctuation_is_known_as_it_is():
    own, whole = Encoder(vocabulary("word_bpe_49k.json")), Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    asked, look_up = [], own._looked_up
    own._looked_up = lambda part: asked.append(part) or look_up(part)
    for text in ("river, stone; river", "river, river, stone;"):
        assert own.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids
    assert asked == ["river,", "stone;"]  # the word alone is known from the first

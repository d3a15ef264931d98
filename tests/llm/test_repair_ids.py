import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from verso.llm import common
from verso.llm import repair_ids as R

PATH = P.path("word_bpe_49k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_word_cache_equals_the_library():
    lib, own = library(), R.word_cache(PATH)
    assert own.direct
    rnd = random.Random(2)
    parts = ["Hello", "été,", "Größe!!", "it's", "'s", "a1b2", "漢字", "<|endoftext|>", "İx", "é", "\t", "\x1c", " ", " ", "\n", "x.y", "&&", "ΣΑΣ", "ª", "ÑÉ", "H\u0331", "µ", "don't."]
    for _ in range(300):
        t = "".join(rnd.choices(parts, k=rnd.randint(0, 9)))
        assert np.frombuffer(own.encode(t), '<u4').tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_round_trip_and_random_access():
    rnd = random.Random(1)
    for n in (0, 1, 5, 3000, 20_000):
        ids = np.array([rnd.choice([3, 7, 7, 7, 9, 11, 40]) for _ in range(n)], dtype="<u4")
        seq, rules, lengths = R.compress(ids, 50, min_count=3)
        assert R.expand(seq, rules, 50).tolist() == ids.tolist()
        if n >= 3000:
            assert len(seq) < n / 2
        for _ in range(30):
            a = rnd.randint(0, n)
            b = rnd.randint(a, n)
            assert R.read_range(seq, rules, lengths, 50, a, b).tolist() == ids[a:b].tolist()


def test_files_equal_brute_force(spark):
    docs = common.documents(spark, "/root/testdata/sf0.001")
    extra = spark.createDataFrame([(10**9, None, "x"), (-5, "", "x"), (None, "null id", "x"), (7, "same id", "x")], "doc_id long, text string, part string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    path = common.scratch_path(spark, "t")
    R.write(docs, PATH, path, shard_tokens=3000)
    got = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in R.read(spark, path).collect()}
    lib, at, want = library(), 0, set()
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    for d, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want.add((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want and len(got) == len(rows)


def test_empty(spark):
    path = common.scratch_path(spark, "t")
    R.write(spark.createDataFrame([], "doc_id long, text string"), PATH, path)
    assert R.read(spark, path).count() == 0

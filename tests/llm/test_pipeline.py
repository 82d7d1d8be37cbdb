"""The registered queries against SQL, and the pipeline against brute force."""

import os
import sys
import zlib
from collections import Counter

import compare
import duckdb
import numpy as np
import pytest
from llm_cases import WORD, brute_groups, brute_lines, brute_mix, brute_quality

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from tunelab.llm import packing  # noqa: E402
from tunelab.llm.catalog import ORACLE, QUERIES  # noqa: E402

SMALL, CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("sf_dir", [SMALL, CHECK])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name, sf_dir):
    assert compare.differences(QUERIES[name](spark, sf_dir), compare.connect(sf_dir).sql(ORACLE[name])) is None


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def brute_pieces(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    found = Counter()
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for start in range(0, len(ids), packing.LENGTH):
            part = ids[start : start + packing.LENGTH]
            found[doc_id, start, len(part), zlib.crc32(part.tobytes())] += 1
    return found


def brute_pipeline(sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{sf_dir}/documents.parquet'").fetchall()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall())
    source = {d: s for d, _, s in rows}
    docs = [x[:2] for x in rows]
    docs = [d for d, keep in zip(docs, brute_quality(docs, labels)) if keep]
    docs = sorted((d, t) for d, _, _, t in brute_lines(docs))
    least = {}
    for (doc_id, _), group in zip(docs, brute_groups(docs)):
        least[group] = min(doc_id, least.get(group, doc_id))
    docs = [d for d in docs if d[0] in set(least.values())]
    taken = {d: t for d, _, _, _, t in brute_mix([(d, t, source[d]) for d, t in docs])}
    mixed = []
    for doc_id, text in docs:
        n = len(WORD.findall(text))
        times, rest = divmod(taken[doc_id], n) if n else (0, 0)
        mixed += [(doc_id, text)] * times
        if rest:
            mixed.append((doc_id, text[: [m.end() for m in WORD.finditer(text)][rest - 1]]))
    return brute_pieces(mixed)


def test_pipeline(spark):
    found = corpus_pipeline.run(spark, SMALL)
    got = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in found.collect())
    assert got == brute_pipeline(SMALL)


def test_stages_take_awkward_documents(spark, documents, no_documents):
    for docs in (documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            if name != "packing":
                assert out.columns == docs.columns
            docs = packing.stored(out, "stage")
        assert docs.count() > 0 or docs.columns

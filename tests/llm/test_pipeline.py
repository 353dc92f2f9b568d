"""The pipeline's stages against brute force, each on its own input."""

import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from corpusmill.llm import mixing, quality
from corpusmill.llm.registry import tokenizer_path

from test_operators import brute_components, brute_tiles, text


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """documents with copies, near copies, junk, toxic texts, benchmark passages, null ids and repeated rows."""
    rng = random.Random(51)
    folder = str(tmp_path_factory.mktemp("tables"))
    items = [(i, text(rng, 18)) for i in range(6)]
    rows, marks = [], []
    for i in range(300):
        kind = i % 6
        body = "WIN $$$ NOW!!! " * rng.randint(8, 30) + str(i) if kind == 1 else text(rng, rng.randint(25, 90))
        if kind == 2:
            body += " awful nasty"
        elif kind == 3 and i > 20:
            words = rows[i - 3][1].split()
            words[rng.randrange(len(words))] = "changed"
            body = " ".join(words)
        elif kind == 4 and i % 4 == 0:
            body = f"{body} {rng.choice(items)[1]} {text(rng, 5)}"
        rows.append((i, body))
        marks.append((i, int(kind != 1), int(kind == 2)))
    rows += [(None, rows[0][1]), (None, None), (400, ""), (0, rows[0][1]), (None, text(rng, 30))]
    spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks[:240], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_against_brute_force(spark, tables):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    items = [r.text.split() for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    out = []
    for name, stage in corpus_pipeline.STAGES:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(spark, docs, tables)
        if name != "token_file":
            assert after.columns == docs.columns, name
        got = after.collect()
        texts = Counter((r.doc_id, r.text) for r in got) if name != "token_file" else None
        if name == "quality":
            pairs = quality.scored(docs, quality.fit(docs, labels)).collect()
            good = Counter(r.doc_id for r in pairs if r.score >= 0.5)
            assert Counter(i for i, _ in texts.elements()) == good and texts <= Counter(rows)
            assert all(t not in [x for _, x in texts] for i, t in rows if t and t.startswith("WIN"))
            assert sum(texts.values()) >= 0.9 * sum(1 for _, t in rows if t and not t.startswith("WIN"))
        elif name == "near_duplicates":
            parts = brute_components(list(enumerate(t for _, t in rows)), 5, Fraction(4, 5))
            groups = {}
            for place, (n, root) in parts.items():
                groups.setdefault(root if n else f"none {place}", []).append(rows[place])
            chosen = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
            assert len(got) == len(groups) and Counter(i for i, _ in texts.elements()) == Counter(i for i, _ in chosen)
        elif name == "decontamination":
            clean = [r for r in rows if not any(brute_tiles(w, (r[1] or "").split(), 5) >= 0.7 * len(w) for w in items)]
            assert texts == Counter(clean) and len(clean) < len(rows)
        elif name == "mixing":
            rated = mixing.mix(docs, labels, corpus_pipeline.WEIGHTS).collect()
            assert set(texts) <= set(rows) and abs(sum(texts.values()) - sum(r.rate for r in rated)) < 0.1 * len(rows)
            assert all(abs(sum(1 for _ in filter(lambda x: x == r, texts.elements())) - 1) <= 2 for r in rows)
        else:
            tokenizer, out = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), Counter()
            for i, t in rows:
                ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
                out[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
            assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == out
        docs = after
    whole = corpus_pipeline.run(spark, tables).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in whole) == out

"""The pipeline as a whole against brute force."""

import hashlib
import zlib

import numpy as np

import corpus_pipeline
from lectern.llm.subwords import word_encoder
from lectern.llm.token_store import default_tokenizer

ITEM = "the quick brown fox jumps over the lazy dog near the old mill. it then sleeps until noon by the door."


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def copies_of(rows):
    """Copies of each document by id: a water level over the sources, then whole documents by their hash."""
    size, h = {r[0]: len((r[1] or "").split()) for r in rows}, {r[0]: int(hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()[:15], 16) for r in rows}
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    weight, total = {s: i % 3 + 1 for i, s in enumerate(sources)}, {s: sum(size[r[0]] for r in rows if r[2] == s) for s in sources}
    low, high = 0.0, 10.0 * sum(total.values())
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * total[s], level * weight[s]) for s in sources) < sum(total.values()) else (low, level)
    out = {}
    for s in sources:
        target, upto = min(3 * total[s], high * weight[s]), 0
        base = int(target / total[s] + 1e-9)
        for i in sorted((r[0] for r in rows if r[2] == s), key=h.get):
            upto += size[i]
            out[i] = base + (2 * upto - size[i] <= 2 * (target - base * total[s])) if size[i] else 0
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(8)
    text = lambda n: " ".join(f"v{k}" for k in rng.integers(0, 5000, n))
    base, toxic = text(40), "you are a stupid idiot. really"
    rows = [(1, base, "a"), (2, base.upper(), "a"), (3, base + " more", "b"), (4, toxic, "b"), (5, f"before {ITEM} after", "a"), (6, ITEM.upper(), None), (7, None, "a"), (8, "", "b"), (9, " \n ", None)]
    rows += [(i, text(int(rng.integers(1, 80))), ("a", "b", None, "c")[i % 4]) for i in range(10, 60)]
    rows += [(i + 100, rows[i][1], rows[i][2]) for i in range(20, 30)]
    d = f"file://{tmp_path}"
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")

    kept = []
    for r in rows:  # of a class the least id stays; here each class is linked to its least member
        if r[1] != toxic and all(5 * len(shingles(r[1]) & shingles(k[1])) < 4 * len(shingles(r[1]) | shingles(k[1])) for k in kept):
            kept.append(r)
    kept = [r for r in kept if ITEM not in (r[1] or "").lower()]
    copies, encoder, at, want = copies_of(kept), word_encoder(default_tokenizer()).tokenizer, 0, []
    for i, t, _ in sorted(kept):
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for _ in range(copies[i]):
            want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
    got = corpus_pipeline.run(spark, d).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert len({i for i, *_ in want}) > 40 and max(copies.values()) > min(copies.values())

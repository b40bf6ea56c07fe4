from __future__ import annotations

import corpus_pipeline as cp
from jsonflow.llm import decontaminate, packing, toxicity
from jsonflow.llm.common import stored
from tests.llm.conftest import SF
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_minhash import brute as brute_near
from tests.llm.test_packing import PATH, checked, expected


def test_stages_match_brute_force(llm):
    """Each stage on what the one before kept."""
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for _, stage in cp.STAGES:
        frames.append(stored(stage(llm, frames[-1], SF)))
    rows = [f.collect() for f in frames]
    texts = [[(r["doc_id"], r["text"]) for r in part] for part in rows[:5]]
    assert all(f.columns == columns for f in frames[:5])

    judged = toxicity.judge(docs, llm.read.parquet(f"{SF}/labels.parquet")).collect()
    assert {d for d, _ in texts[1]} == {r["doc_id"] for r in judged if not r["predicted"]}
    lines = brute_lines(texts[1])
    assert dict(texts[2]) == {d: t for d, (t, _, n) in lines.items() if not n or t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2])
    kept = {d for d, _, _, k in brute_near(texts[2], cp.NEAR_PERCENT) if k}
    assert {d for d, _ in texts[3]} == kept
    items = [tuple(r) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    finder = decontaminate.Finder(items, decontaminate.RATE)
    assert {d for d, _ in texts[4]} == {d for d, t in texts[3] if not finder.find(decontaminate.plain(t))}
    from tokenizers import Tokenizer

    pieces, _ = checked(rows[5], packing.CAPACITY)
    assert pieces == expected(Tokenizer.from_file(PATH), texts[4], packing.CAPACITY)
    # Too few rows are labelled here to tell toxic ones; all other filters had something to do.
    sizes = [len(part) for part in texts]
    assert sizes == sorted(sizes, reverse=True) and sizes[1] > sizes[2] > sizes[3] > sizes[4]


def test_run_gives_the_last_stage(llm):
    out = cp.run(llm, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_odd_rows_and_empty_tables(llm, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        columns = docs.columns
        for _, stage in cp.STAGES[:4]:
            docs = stored(stage(llm, docs, SF))
            assert docs.columns == columns
        assert stored(cp.STAGES[4][1](llm, docs, SF)).count() >= docs.count()

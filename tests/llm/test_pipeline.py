import base64
import hashlib
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import tiktoken

from gleanery.llm import simhash
from gleanery.llm.common import table

from .test_linededup import brute as brute_lines
from .test_simhash import brute_components, brute_print

ROOT = Path(__file__).resolve().parents[2]


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    columns, outs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        docs = outs[name] = spark.read.parquet(str(tmp_path / name))
        if name != "byte_bpe":
            assert docs.columns == columns
    rows = {n: [(r.doc_id, r.text) for r in d.collect()] for n, d in outs.items() if n != "byte_bpe"}
    before = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}

    assert 0 < len(rows["toxicity"]) < len(before)
    assert all(before[i] == t for i, t in rows["toxicity"])
    assert dict(rows["line_dedup"]) == brute_lines(rows["toxicity"])

    prints = {i: brute_print(t) for i, t in rows["line_dedup"]}
    groups = brute_components(set(prints.values()))
    first = {}
    for i, p in sorted(prints.items()):
        first.setdefault(min(groups[p]), i)
    assert sorted(i for i, _ in rows["near_duplicates"]) == sorted(first.values())
    assert dict(rows["near_duplicates"]).items() <= dict(rows["line_dedup"]).items()

    assert set(rows["mixing"]) <= set(rows["near_duplicates"])
    assert max(rows["mixing"].count(r) for r in set(rows["mixing"])) <= 3

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = outs["byte_bpe"].collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows["mixing"])
    texts = dict(rows["mixing"])
    for r in got:
        ids = bpe.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids) and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_stages_take_odd_rows(spark, odd, empty, sf):
    for docs in (odd.withColumn("source", odd["ids"]), empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert out.count() >= 0, name
    kept = simhash.keep_first(odd)
    assert kept.columns != [] and kept.where("doc_id is null").count() == 1


def test_entry_without_the_package(tmp_path):
    """The rest still imports and registers its queries when both folders are gone."""
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py",
                                                                          "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sorted(k for k in q if k.startswith('op')))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True,
                         env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path / "repo")})
    assert got.returncode == 0, got.stderr
    assert got.stdout.split(" ", 1)[1].strip().endswith("[]") and int(got.stdout.split()[0]) > 100

import json
import subprocess
import sys
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from helpers import documents
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "language", "near_dedup", "substring_dedup", "decontamination", "packing"]


def test_run_equals_the_stages_written_and_read(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(f"{tmp_dir}/{i}")
        docs = spark.read.parquet(f"{tmp_dir}/{i}")
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ran = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, ran.select(own).collect())) == sorted(map(tuple, docs.select(own).collect()))


def test_planted_cases(spark, tmp_dir):
    clean = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) between 400 and 2000")
             .orderBy("doc_id").limit(8).collect()]
    clean = [c for i, c in enumerate(clean) if c not in clean[:i]][:6]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    passage = " ".join(f"pass{i}age" for i in range(55))
    near = clean[0].split()
    near[5] = "changed"
    texts = [*clean, clean[1], " ".join(near), f"{clean[2][:200]} {item} {clean[3][:150]}",
             f"{clean[4][:150]} {passage} {clean[5][:120]}", f"{clean[5][:110]} {passage}", "12 34 %%", None, ""]
    documents(spark, texts).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs, steps = spark.read.parquet(f"{tmp_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmp_dir).cache()
        steps.append({r["doc_id"]: r["text"] for r in docs.collect()})
    n = len(clean)
    assert set(steps[0]) == set(range(len(texts))) - {n + 5, n + 6, n + 7}
    assert n not in steps[1] and n + 1 not in steps[1] and set(range(n)) <= set(steps[1])
    assert not any(passage in t for t in steps[2].values()) and set(steps[2]) == set(steps[1])
    assert item not in steps[3][n + 2] and clean[2][:100] in steps[3][n + 2]
    model = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    packed = corpus_pipeline.packing(spark, docs, tmp_dir).collect()
    for i in range(2, 4):
        ids = model.encode(steps[3][i], add_special_tokens=False).ids + [2]
        mine = sorted((r["start"], r["length"], r["ids_crc32"]) for r in packed if r["doc_id"] == i)
        assert sum(x[1] for x in mine) == len(ids)
        assert all(zlib.crc32(np.array(ids[s:s + k], "<u4").tobytes()) == c for s, k, c in mine)


def test_empty_documents(spark, tmp_dir):
    documents(spark, []).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []


def test_library_imports_without_the_subpackage():
    code = ("import sys, importlib.util as u\nreal = u.find_spec\n"
            "u.find_spec = lambda n, p=None: None if n.startswith(('loadsmith.llm', 'corpus_pipeline')) else real(n, p)\n"
            "import json, __spark_entry__ as e\nprint(json.dumps([sorted(e.queries()), [m for m in sys.modules if 'llm' in m]]))")
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout
    names, loaded = json.loads(said.strip().splitlines()[-1])
    assert names and not loaded and not any(n.startswith("op") and "_" in n and n[2].isdigit() for n in names)

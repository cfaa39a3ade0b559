import importlib
import random
import zlib
from itertools import combinations

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from codegraph.llm import common, linededup, mixing, toxicity
from test_similarity import brute_components
from tokenizers import Tokenizer


def test_pipeline_on_a_small_corpus(spark, tmp_path):
    clean = [(d, f"clean text number {d} " + " ".join(f"w{d * k % 97}x{k}" for k in range(40)) + f"\nshared closing line of all of these documents here {d % 2}", f"s{d % 3}") for d in range(60)]
    copies = [(100 + d, clean[d][1].split("\n")[0] + " tail", "s9") for d in range(5)]
    toxic = [(200 + d, f"you are a grumblewort {d} " + " ".join(f"t{d}y{k}" for k in range(20)), "s1") for d in range(40)]
    rows = [(d, t, "en", s, len(t)) for d, t, s in clean + copies + toxic] + [(300, None, None, None, None), (301, "", "en", "s1", 0)]
    pq.write_table(pa.table({n: [r[k] for r in rows] for k, n in enumerate(("doc_id", "text", "lang", "source", "n_chars"))}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": [r[0] for r in rows[:-2]], "quality": [1] * (len(rows) - 2), "toxic": pa.array([int(200 <= r[0] < 300) for r in rows[:-2]], pa.int32())}), tmp_path / "labels.parquet")
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.materialise(stage(spark, docs, str(tmp_path)), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    assert not any(200 <= d < 300 for d in ids["toxicity"]) and {d for d, *_ in clean} | {300, 301} <= ids["toxicity"]
    assert ids["line_dedup"] == ids["toxicity"]
    texts = [r.text for r in seen["line_dedup"].collect() if r.text]
    assert sum("shared closing line" in t for t in texts) == 1
    assert {d for d, *_ in clean} <= ids["jaccard_join"] and ids["mixing"] == ids["jaccard_join"] == ids["packing"]
    assert seen["mixing"].count() == seen["jaccard_join"].count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["packing"].count()


def toxic_by_definition(model, text):
    """Weights of the words that a term fits, the heaviest each, without words that an exception phrase spares."""
    words = toxicity.fold(text).split()
    fits = lambda term, w: w == term.strip() if term.endswith(" ") else w.startswith(term.strip())
    spared = set()
    for k in range(len(words) - 1):
        if term := model.exceptions.get(f" {words[k]} {words[k + 1]} "):
            spared.add(k if fits(term, words[k]) else k + 1)
    weight = sum(max((v for t, v in model.terms.items() if fits(t, w)), default=0.0) for k, w in enumerate(words) if k not in spared)
    return toxicity.curve_value(model.curve, weight, len(words)) >= 0.3


def lines_by_definition(rows):
    first = {}
    for place, words in sorted(((d, k), tuple(line.split())) for d, t in rows for k, line in enumerate(t.split("\n")) if line.split()):
        first.setdefault(words, place)
    near = {max(x, y) for (a, x), (b, y) in combinations(first.items(), 2) if (least := min(len(a), len(b))) >= 8 and abs(len(a) - len(b)) <= max(1, least // 10) and linededup.word_distance(" ".join(a), " ".join(b)) <= max(1, least // 10)}
    stays = lambda d, k, line: not line.split() or first[tuple(line.split())] not in near and first[tuple(line.split())] == (d, k)
    return [(d, "\n".join(line for k, line in enumerate(t.split("\n")) if stays(d, k, line))) for d, t in rows]


def test_run_by_brute_force(spark, tmp_path):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(rng.choice([3, 9, 14, 30]))) for _ in range(60)]
    rows = []
    for d in range(150):
        lines = [rng.choice(pool) if rng.random() < 0.3 else " ".join(f"w{rng.randint(0, 900)}" for _ in range(rng.randint(4, 40))) for _ in range(rng.randint(1, 6))]
        if d % 6 == 0:
            lines.append(f"what a {rng.choice(['grubble', 'snorfish', 'zonk'])} you are {rng.randint(0, 999)}")
        if d % 10 == 3 and rows:  # near copies that survive the line stage, cut in other places
            lines = [" ".join(rows[-1][1].split())]
        rows.append((d, "\n".join(lines)))
    columns = {"doc_id": [d for d, _ in rows], "text": [t for _, t in rows], "lang": ["en"] * 150, "source": [f"s{d * d % 4}" for d, _ in rows], "n_chars": [len(t) for _, t in rows]}
    pq.write_table(pa.table(columns), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": [d for d, _ in rows], "quality": [1] * 150, "toxic": pa.array([int(d % 6 == 0) for d, _ in rows], pa.int32())}), tmp_path / "labels.parquet")
    documents, labels = (spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in ("documents", "labels"))
    model = toxicity.learn(toxicity.training_rows(documents, labels))
    clean = [(d, t) for d, t in rows if not toxic_by_definition(model, t)]
    assert 100 < len(clean) < 150
    unique = lines_by_definition(clean)
    assert unique != clean
    groups = brute_components(unique)
    kept = {d: t for d, t in unique if groups[d, t][1] == d}
    assert len(kept) < len(unique)
    tokenizer = Tokenizer.from_file(common.tokenizer_path())
    tokenizer.encode_special_tokens = True
    want = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in kept.items()}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    for r in pieces:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    covered = {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        assert r.start == covered.get(r.doc_id, 0)
        covered[r.doc_id] = r.start + r.length
    assert covered == {d: len(ids) for d, ids in want.items()}


def test_stages_on_odd_documents(spark, odd, tmp_path):
    names = ["a.b", "__n_lines", "__gone", "__kept", "__part", "__slot", "__position", "c0", "c1", "kept", "kept_lines"]
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars").selectExpr("*", *(f"CASE WHEN doc_id % 2 = 0 THEN 'x{k}' END AS `{n}`" for k, n in enumerate(names)))
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for rows, marks in ((docs, labels), (docs.limit(0), labels), (docs, labels.limit(0))):
        marks.write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
        held = rows
        for name, stage in corpus_pipeline.STAGES:
            before, held = held, common.materialise(stage(spark, held, str(tmp_path)), name)
            if name != "packing":
                assert held.schema.names == before.schema.names
            if name in ("toxicity", "line_dedup", "mixing"):
                assert held.count() == before.count()
            if name in ("line_dedup", "mixing"):
                kept = lambda d: sorted(map(str, d.drop("text", "n_chars").collect()))
                assert kept(held) == kept(before)
            if name == "line_dedup" and held.count():
                texts = {(r.doc_id, r.text) for r in held.select("doc_id", "text").collect()}
                assert {(2, None), (3, ""), (4, " \n\t \r\n "), (8, "")} <= texts and any(i == 5 and len(t) > 400_000 for i, t in texts)
            if name == "jaccard_join" and held.count():
                assert {r.doc_id for r in held.select("doc_id").collect()} >= {1, 2, 3, 4, 5, 6, 7, None}


def test_packing_follows_the_mix_over_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "BYTES_A_PART", 60_000)
    words = lambda d: " ".join(f"w{d}x{k}" for k in range(20 + d))
    docs = spark.createDataFrame([(d, words(d), "en", "many" if d % 4 else "few", 0) for d in range(400)], "doc_id long, text string, lang string, source string, n_chars long")
    place = {r.doc_id: r.position for r in mixing.schedule(docs).collect()}
    stages = dict(corpus_pipeline.STAGES)
    mixed = common.materialise(stages["mixing"](spark, docs, ""), "mixing", f"{tmp_path}/mixed")
    assert len(list((tmp_path / "mixed").glob("*.parquet"))) > 3
    parts = {}
    for r in stages["packing"](spark, mixed, "").select("doc_id", "sequence_id").collect():
        parts.setdefault(r.sequence_id >> 40, set()).add(place[r.doc_id])
    ranges = [(min(p), max(p)) for _, p in sorted(parts.items())]
    assert len(ranges) > 3 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_the_entry_module_goes_without_the_subpackage(monkeypatch):
    import __spark_entry__ as entry

    whole = set(entry.queries())
    assert {n for n in whole if n.startswith("op")} and "pipeline" in whole
    real = importlib.import_module

    def without(name, *rest):
        if name.startswith("codegraph.llm"):
            raise ImportError(name)
        return real(name, *rest)

    monkeypatch.setattr(importlib, "import_module", without)
    assert set(entry.queries()) == {n for n in whole if not n.startswith("op") and n != "pipeline"} and set(entry.oracle_sql()) <= set(entry.queries())

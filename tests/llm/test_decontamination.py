import hashlib
import random
import re

import pytest
from codegraph.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if names := windows.get(tuple(words[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= names
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def as_rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    vocabulary = [*"abcdefg", "É", "é", "日本", "x9"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 3, 4, 9, 10, 11, 30, 60]) if k % 3 else 25)) for k in range(60)] + [(3, text(14)), (None, text(12)), (70, None), (71, " .. "), (72, "Q" * 40_000)]
    docs = []
    for k in range(200):
        body = text(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(items)[1] or ""
            at = rng.randrange(len(body) + 1)
            body = body[:at] + " " + item[rng.randrange(len(item) + 1) :].upper() + " " + body[at:]
        docs.append((k, body))
    docs += [(500, None), (501, ""), (None, items[0][1]), (7, items[0][1]), (7, items[0][1]), (7, "another text"), (502, "a b c " * 20_000 + items[5][1]), (503, "q" * 40_000)]
    return docs, items, spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, words string"), spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, length int")


def test_contamination_by_definition(tables):
    docs, items, documents, benchmark = tables
    expected = plain(docs, items)
    assert as_rows(decontamination.contamination_digest(documents, benchmark)) == sorted(map(repr, expected))
    assert {r[3] for r in expected} >= {0, 1, 2}


def test_blocks_and_other_sizes(tables):
    documents, benchmark = tables[2:]
    long_items = benchmark.filter("item_id is null or size(split(text, '[^a-zA-Z0-9É日é]+')) > 0")
    whole = decontamination.contamination(documents, long_items, 6)
    cut = decontamination.contamination(documents, long_items, 6, shingle=2, block_bytes=1500, block_keys=40)
    assert as_rows(whole) == as_rows(cut)


def test_empty_tables_and_dropped_documents(spark, odd, tables):
    docs, items, documents, benchmark = tables
    assert decontamination.contamination_digest(documents.limit(0), benchmark).count() == 0
    assert decontamination.contamination_digest(documents, benchmark.limit(0)).filter("contaminated or n_items > 0").count() == 0
    bench = spark.createDataFrame([(1, "seven EIGHT nine ten a line"), (2, "語")], "item_id long, text string")
    expected = plain([(r.doc_id, r.text) for r in odd.collect()], [(1, "seven EIGHT nine ten a line"), (2, "語")])
    assert as_rows(decontamination.contamination_digest(odd, bench)) == sorted(map(repr, expected))
    kept = decontamination.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == sum(not r[5] for r in expected)


def test_no_python_in_the_plan(tables):
    plan = decontamination.contamination_digest(tables[2], tables[3])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)

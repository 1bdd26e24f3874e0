import random
from collections import Counter, defaultdict
from zlib import crc32

from subscope.llm import sharding


def laws(found, rows):
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in rows)
    counts = Counter(r["shard"] for r in found)
    assert max(counts.values()) - min(counts.values() if len(counts) == 24 else [0]) <= 1
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def groups(found, rows):
    shard = {r["doc_id"]: r["shard"] for r in found}
    by_text = defaultdict(list)
    for i, text in rows:
        if text is not None:
            by_text[text].append(shard[i])
    return [set(v) for v in by_text.values() if len(v) > 1]


def test_tricky_rows(make_docs, tricky):
    found = sharding.sharded(make_docs(tricky)).collect()
    laws(found, tricky)
    texts = dict(tricky)
    for r in found:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, crc32(data))


def test_small_groups_stay_together(make_docs):
    rng = random.Random(1)
    rows = [(i, f"text {i}") for i in range(1500)] + [(2000 + i, f"copy {rng.randrange(250)}") for i in range(900)]
    found = sharding.sharded(make_docs(rows)).collect()
    laws(found, rows)
    assert sum(len(g) > 1 for g in groups(found, rows)) == 0


def test_a_third_of_all_rows_alike_fills_few_shards(make_docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 50)
    rows = [(i, "same" if i % 3 == 0 else f"text {i}") for i in range(2400)]
    found = sharding.sharded(make_docs(rows)).collect()
    laws(found, rows)
    assert len(groups(found, rows)[0]) <= 9  # 800 copies need 8 shards of 100


def test_all_alike_and_empty(make_docs):
    rows = [(i, "same") for i in range(100)]
    laws(sharding.sharded(make_docs(rows)).collect(), rows)
    assert sharding.sharded(make_docs([], 1)).count() == 0
    one = [(None, "x"), (5, None)]
    laws(sharding.sharded(make_docs(one)).collect(), one)

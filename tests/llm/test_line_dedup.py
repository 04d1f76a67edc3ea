import random
from hashlib import sha256

import pytest

from edge_texts import EDGE_ROWS
from orderline_kpi.llm import line_dedup, packing
from orderline_kpi.llm.queries import QUERIES
from llm_fixtures import documents, package_for_workers  # noqa: F401


def shingles(line):
    return {line[k:k + 7] for k in range(max(1, len(line) - 6))}


def plain_gone(rows):
    """The lines that go, by comparing all pairs: of each component all but the first."""
    lines, places = {}, []
    for doc, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            line = " ".join(line.lower().split())
            if line:
                lines.setdefault(line, len(lines))
                places.append((doc, number, lines[line]))
    sets = [shingles(line) for line in lines]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(sets)):
        for j in range(i):
            if 0.8 * len(sets[i]) <= len(sets[j]) <= len(sets[i]) / 0.8:
                shared = len(sets[i] & sets[j])
                if shared / (len(sets[i]) + len(sets[j]) - shared) >= 0.8:
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    seen, gone = set(), {}
    for doc, number, line in places:
        if find(line) in seen:
            gone.setdefault(doc, []).append(number)
        seen.add(find(line))
    return gone


def made_rows():
    """Documents out of a few sentences, copied with errors, so that there are dense and loose groups."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    sentences = [" ".join(rng.choices(words, k=rng.randint(6, 40))) for _ in range(25)]
    rows = []
    for doc in range(120):
        lines = []
        for sentence in rng.sample(sentences, 4):
            parts = sentence.split()
            for _ in range(rng.randint(0, 4)):
                parts[rng.randrange(len(parts))] = rng.choice(words)
            lines.append(" ".join(parts))
        rows.append((doc, "\n".join(lines)))
    return rows


def test_whole_table_loses_every_equal_line(spark, tables_dir):
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{tables_dir}/documents.parquet").collect()}
    seen = set()
    for row in QUERIES["op5_line_dedup"](spark, tables_dir).orderBy("doc_id").collect():
        lines, gone = docs[row["doc_id"]].split("\n"), set(row["gone"])
        normal = [" ".join(line.lower().split()) for line in lines]
        assert row["n_lines"] == sum(map(bool, normal)) and row["n_removed"] == len(gone)
        left = "\n".join(line for k, line in enumerate(lines) if k not in gone)
        assert row["kept_sha256"] == sha256(left.encode()).hexdigest()
        for k, line in enumerate(normal):
            assert not line or k in gone or line not in seen
            seen.add(line)


def test_fuzzy_groups_equal_brute_force(documents):
    rows = made_rows()
    got = {row["doc_id"]: row["gone"] for row in line_dedup.remove_lines(documents(*rows)).collect() if row["gone"]}
    expected = plain_gone(rows)
    # Bands may miss a pair at the very threshold; here none is missed.
    assert got == expected


def test_many_buckets_find_the_same(documents, monkeypatch):
    rows = made_rows()[:12]
    monkeypatch.setattr(line_dedup, "_BUCKET_ENTRIES", 0.01)
    monkeypatch.setattr(line_dedup, "bucket_bits", lambda spark, n, each: packing.bucket_bits(spark, int(n / each), 1))
    got = {row["doc_id"]: row["gone"] for row in line_dedup.remove_lines(documents(*rows)).collect() if row["gone"]}
    assert got == plain_gone(rows)


def test_edge_rows(documents):
    docs = documents(*EDGE_ROWS)
    rows = line_dedup.remove_lines(docs).collect()
    assert len(rows) == len(EDGE_ROWS)
    of = {row["doc_id"]: row for row in rows if row["doc_id"] not in (None, 9)}
    assert of[1]["text"] is None and of[2]["text"] == "" and of[3]["text"] == " \t\n "
    assert of[10]["text"] == "LINE one\n\n" and of[10]["gone"] == [2, 3] and of[10]["n_lines"] == 3
    # Rows that agree in id and text are one document.
    assert sorted(row["text"] for row in rows if row["doc_id"] == 9) == ["another text with that id", "the same row", "the same row"]
    assert rows[0]["id"] == "extra" and rows[0]["n_words"] == -1


@pytest.mark.parametrize("size", [1, 6, 7, 8, 400])
def test_signatures_do_not_depend_on_neighbours(size):
    line = "xyzw" * 200
    alone = line_dedup.signatures([line[:size]])
    among = line_dedup.signatures(["some other line", line[:size], "a", "b" * 100_000])
    assert (alone[0] == among[1]).all()


def test_near_copies_fill_no_bucket(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    template = rng.choices(words, k=40)
    rows = []
    for doc in range(6000):
        near = template.copy()
        near[rng.randrange(40)] = rng.choice(words)
        rows.append((doc, 0, "\n".join([" ".join(near), " ".join(rng.choices(words, k=12))])))
    texts = spark.createDataFrame(rows, "id long, tie long, text string").repartition(8)
    sent = texts.mapInPandas(line_dedup._entries(6), packing.SCHEMA).groupBy("bucket").sum("entries").toPandas()
    for sizes in (sent[sent["bucket"] < 64]["sum(entries)"], sent[sent["bucket"] >= 64]["sum(entries)"]):
        assert len(sizes) == 64 and sizes.max() < 3 * sizes.median()


def test_heads_of_batches_meet(documents, monkeypatch):
    # Batches of a few lines, so that heads of one band, equal and unequal ones, come from many batches.
    rows = made_rows()[:40]
    rows = [(3 * doc + k, text) for doc, text in rows for k in range(2)]
    monkeypatch.setattr(line_dedup, "_BATCH_CHARS", 1500)
    got = {row["doc_id"]: row["gone"] for row in line_dedup.remove_lines(documents(*rows)).collect() if row["gone"]}
    assert got == plain_gone(rows)


def test_lines_of_white_space_in_any_script_do_not_count(documents):
    rows = line_dedup.remove_lines(documents((1, "a line\n\u00a0\u2003\n\x1c\n\u00a0\u2003"))).collect()
    assert rows[0]["n_lines"] == 1 and rows[0]["gone"] == []

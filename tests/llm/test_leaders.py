"""Large groups of near copies, whose least set may lie at the edge of the group."""

from jobsift.llm import jaccard
from jobsift.session import ship_package


def near_copies(n):
    """Copies of one text with 0 to 4 words changed, most of them far from each other's changes."""
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        copy = list(words)
        for k in range(i % 5):
            copy[10 + (i * 37 + k * 61) % 280] = f"x{i}y{k}"
        rows.append((i, " ".join(copy)))
    return rows


def test_pairs_of_a_large_group_of_near_copies(spark, monkeypatch):
    ship_package(spark)
    made, real = {}, jaccard.stored

    def counted(df, name):
        table = real(df, name)
        made[name] = table.count()
        return table

    monkeypatch.setattr(jaccard, "stored", counted)
    n = 200
    docs = spark.createDataFrame(near_copies(n), "doc_id long, text string").repartition(4)
    groups = {r.doc_id: r.component_id for r in jaccard.similar_groups(docs).collect()}
    assert groups == dict.fromkeys(range(n), 0)
    assert made["open-pairs"] <= n and made["links"] <= 30 * n

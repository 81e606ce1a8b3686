"""Components and near copies with tables broadcast or not."""

from __future__ import annotations

from launchcohort.llm import components, minhash
from launchcohort.session import written


def test_components_stop_at_stars_and_go_on_without_broadcasts(spark, monkeypatch):
    """One round makes these links stars; no further round is written to see that nothing changes."""
    made = []
    monkeypatch.setattr(components, "written", lambda df, name: made.append(name) or written(df, name))
    hub = spark.createDataFrame([(50, k) for k in range(51, 90)] + [(k, 50) for k in range(51, 60)], "a long, b long")
    assert dict(map(tuple, components.components(hub).collect())) == {k: 50 for k in range(50, 90)} and made == ["stars"]
    chain = spark.createDataFrame([(k * 37 % 101, (k + 1) * 37 % 101) for k in range(100)] + [(200, 201), (None, 1)], "a long, b long")
    want = {**{k: 0 for k in range(101)}, 200: 200, 201: 200}
    for limit in (components.BROADCAST_LINKS, 0):
        monkeypatch.setattr(components, "BROADCAST_LINKS", limit)
        assert dict(map(tuple, components.components(chain).collect())) == want
    assert components.components(chain.limit(0)).count() == 0


def test_near_duplicates_alike_with_and_without_broadcasts(spark, monkeypatch):
    """Chains of near copies: each text differs from the next in two of 60 words; and texts of their own."""
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[2 * j:2 * j + 60]) for j in range(40)] + [" ".join(f"x{j}y{k}" for k in range(30)) for j in range(9)]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts + texts[:5])], "doc_id long, text string")
    want = [(k, 59, 0) for k in range(40)] + [(k, 29, k) for k in range(40, 49)] + [(k, 59, 0) for k in range(49, 54)]
    for nodes, pairs in ((minhash.BROADCAST_NODES, minhash.BROADCAST_PAIRS), (0, 0)):
        monkeypatch.setattr(minhash, "BROADCAST_NODES", nodes)
        monkeypatch.setattr(minhash, "BROADCAST_PAIRS", pairs)
        got = minhash.near_duplicates(d, words_per=2).select("id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got)) == want

"""What the Python workers of the corpus pipeline hold."""

from hayloft.llm import decontam, quality, simhash
from hayloft.llm import words as W


def test_a_worker_gives_memory_back_when_its_task_ends(monkeypatch):
    given = []
    monkeypatch.setattr(W, "give_back", lambda: given.append(1))
    assert list(W.giving_back(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3] and given == [1]
    for run in (simhash._fingerprints(4, ["id"]), decontam._candidates([5], 13, None), quality._judge(["row"], None)):
        assert run.__qualname__ == "giving_back.<locals>.task"

from vantage.llm import common
from vantage.llm.textops import powers


class Task:
    def __init__(self, stage):
        self.stage = stage

    def stageId(self):
        return self.stage


def test_tables_last_for_a_stage(monkeypatch):
    own = common.kept()
    monkeypatch.setattr(common.TaskContext, "get", staticmethod(lambda: Task(5)))
    common.begin_task()
    own["x"] = 1
    powers(10)
    common.begin_task()
    assert own == {"x": 1}
    monkeypatch.setattr(common.TaskContext, "get", staticmethod(lambda: Task(6)))
    common.begin_task()
    assert own == {} and len(powers(10)) > 10
    common._TABLES.remove(own)

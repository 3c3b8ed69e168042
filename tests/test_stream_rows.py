"""The processor of the rating stream on plain rows, with a state that counts its calls."""

import datetime as dt

from pyspark.sql import Row

from duelmetrics.operators.elo import RATED
from duelmetrics.streaming.rating_state import PoolRatings


class State:
    def __init__(self):
        self.held, self.asked = {}, []

    def getValue(self, key):
        self.asked.append(key)
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value


def test_a_player_is_asked_for_once_and_rows_come_in_order():
    columns = ["match_id", "player1", "player2", *RATED, "winner", "match_date", "pool"]
    made = PoolRatings("pool", columns, 32, 1500)
    made.ratings = State()
    day = dt.datetime(2024, 1, 1)
    rows = [Row(match_id=i, player1="a", player2="b", winner=w, match_date=d, pool=None)
            for i, w, d in [(3, "a", day), (2, "b", day), (9, "a", None), (None, "a", day)]]
    log = list(made.handleInputRows((None,), iter(rows), None))
    assert [r.match_id for r in log] == [9, None, 2, 3]
    assert [(r.player1_elo_before, r.player1_elo_after) for r in log] == [(1500, 1516), (1516, 1531), (1531, 1512), (1512, 1527)]
    assert sorted(made.ratings.asked) == [("a",), ("b",)] and list(log[0].asDict()) == columns
    assert made.ratings.held == {("a",): (1527,), ("b",): (1473,)}

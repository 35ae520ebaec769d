"""State that sees a key's seconds in order, whatever the order of arrival.

What arrives is added up per key and second and waits until the watermark has passed that
second; only then is it worked on, in order. So late rows within the allowed lateness count
as if they had come in time, a second has one entry however many rows it has, and what a key
waits with is bounded by the seconds of the lateness.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class OrderedSeconds(StatefulProcessor):
    """Rows with ``second`` and ``amount``, worked on per key in order of second.

    Subclasses say how two amounts of one second combine, and what a second does to
    the key's state; ``expires`` may name a second at which the state is dropped.
    """

    STATE = "value bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "second bigint", "amount bigint")
        self.state = handle.getValueState("state", self.STATE)

    def combined(self, a: int, b: int) -> int:
        return a + b

    def step(self, key, second: int, amount: int, state: tuple | None) -> tuple[tuple | None, list[Row]]:
        """(the state after the second, the rows it gives)."""
        raise NotImplementedError

    def expires(self, state: tuple) -> int | None:
        """The second after which the state means nothing."""
        return None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        added: dict[int, int] = {}
        for row in rows:
            added[row.second] = self.combined(added[row.second], row.amount) if row.second in added else row.amount
        for second, amount in added.items():
            if self.waiting.containsKey((second,)):
                amount = self.combined(self.waiting.getValue((second,))[0], amount)
            else:
                self.handle.registerTimer((second + 1) * 1000)
            self.waiting.updateValue((second,), (amount,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        due = sorted((k[0], v[0]) for k, v in self.waiting.iterator() if k[0] < passed)
        state = tuple(self.state.get()) if self.state.exists() else None
        before, out = state, []
        for second, amount in due:
            state = self._alive(state, second)
            state, rows = self.step(key, second, amount, state)
            out += rows
            self.waiting.removeKey((second,))
        state = self._alive(state, passed)
        if state != before:
            if state is None:
                self.state.clear()
            else:
                self.state.update(state)
                end = self.expires(state)
                if end is not None:
                    self.handle.registerTimer((end + 2) * 1000)
        return iter(out)

    def _alive(self, state: tuple | None, second: int) -> tuple | None:
        end = None if state is None else self.expires(state)
        return None if end is not None and second > end else state

    def close(self) -> None:
        pass

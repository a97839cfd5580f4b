"""Stateful processors: state in several variables, of which a row touches few.

Texts of a response are appended to list state, rows that wait for a gap lie in map state by number,
and the rest is one small JSON text. So what a micro-batch writes goes by its own rows, not by the
length of the response so far. These need the RocksDB state store (`STORE`).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chatlog.streaming.readers import LineReader, SegmentReader

STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
TEXTS = ("buffer", "why")


class ListedPieces:
    """`readers.Pieces` over list states; the pieces of one call are appended together."""

    def __init__(self, lists: dict, used: list[str]):
        self.lists, self.used, self.new = lists, used, {}

    def add(self, name: str, text: str) -> None:
        if text:
            self.new.setdefault(name, []).append(text)

    def take(self, name: str) -> str:
        before = [row[0] for row in self.lists[name].get()] if name in self.used else []
        if before:
            self.lists[name].clear()
            self.used.remove(name)
        return "".join([*before, *self.new.pop(name, [])])

    def save(self) -> None:
        for name, texts in self.new.items():
            self.lists[name].appendList([(t,) for t in texts])
            if name not in self.used:
                self.used.append(name)


class SegmentProcessor(StatefulProcessor):
    """Numbered event lines of a response to (response_id, seq, kind, text) segments."""

    def __init__(self, holdback: int, mode: str, patience: int):
        self.holdback, self.mode, self.patience = holdback, mode, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "state string")
        self.held = handle.getMapState("held", "number bigint", "line string")
        self.lists = {name: handle.getListState(name, "text string") for name in TEXTS}

    def close(self) -> None:
        pass

    def _load(self) -> dict:
        row = self.head.get()
        return json.loads(row[0]) if row else {"next": 0, "n_held": 0, "used": []}

    def _save(self, head: dict, timers) -> None:
        """Every call to the store is a round trip: the timer is set once, and moved on when it has run out."""
        head["seen"] = timers.getCurrentProcessingTimeInMs()
        if "timer" not in head:
            head["timer"] = head["seen"] + self.patience
            self.handle.registerTimer(head["timer"])
        self.head.update((json.dumps(head),))

    def _ready(self, head: dict, rows: dict[int, str]) -> Iterator[tuple[int, str]]:
        """The rows that come next without a gap; the others go to map state."""
        while True:
            number = head["next"]
            if number in rows:
                line = rows.pop(number)
            elif head["n_held"] and self.held.containsKey((number,)):
                line = self.held.getValue((number,))[0]
                self.held.removeKey((number,))
                head["n_held"] -= 1
            else:
                break
            head["next"] = number + 1
            yield number, line
        for number, line in rows.items():
            if not (head["n_held"] and self.held.containsKey((number,))):
                head["n_held"] += 1
            self.held.updateValue((number,), (line,))

    def _read(self, key: tuple, head: dict, rows) -> pd.DataFrame:
        pieces, out = ListedPieces(self.lists, head["used"]), []
        lines, chunks = LineReader(head), SegmentReader(head, self.holdback, self.mode, pieces)
        for number, line in rows:
            chunk = lines.read(line or "")
            if chunk and not head.get("done"):
                out += [(key[0], number, kind, text) for kind, text in chunks.read(*chunk)]
        pieces.save()
        return pd.DataFrame(out, columns=["response_id", "seq", "kind", "text"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        head, mine = self._load(), {}
        if not head.get("done"):  # what follows the end is not read
            for pdf in rows:
                mine.update((n, line) for n, line in zip(pdf["line_no"].tolist(), pdf["line"].tolist()) if n >= head["next"])
            found = self._read(key, head, self._ready(head, mine))
            if head.get("done"):
                head = self._only_done(head)
            if len(found):
                yield found
        self._save(head, timerValues)

    def _only_done(self, head: dict) -> dict:
        """A response that is done holds nothing but that, until it is forgotten."""
        if head["n_held"]:
            self.held.clear()
        for name in head["used"]:
            self.lists[name].clear()
        return {"done": True, **({"timer": head["timer"]} if "timer" in head else {})}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        head = self._load()
        if head["seen"] + self.patience > timerValues.getCurrentProcessingTimeInMs():  # there were rows since
            head["timer"] = head["seen"] + self.patience
            self.handle.registerTimer(head["timer"])
            self.head.update((json.dumps(head),))
            return
        head.pop("timer")
        if head.get("done"):
            self.head.clear()
            return
        late = sorted((number[0], line[0]) for number, line in self.held.iterator()) if head["n_held"] else []
        if late:
            self.held.clear()
            head["n_held"], head["next"] = 0, late[-1][0] + 1
        found = self._read(key, head, late)
        if head.get("done"):
            head = self._only_done(head)
        self._save(head, timerValues)
        if len(found):
            yield found

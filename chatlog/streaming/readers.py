"""Per-response state of the keyed stream operators.

Small state machines: rows of a response come in, text that is ready goes out. State is a plain
dict of bounded size, kept between micro-batches as JSON; texts that grow with the response
are handed to `Pieces`, which may append them to a list outside of it.
"""

from __future__ import annotations

import json
import re

from chatlog import fixed

_BLOCK = re.compile(fixed.THINK_BLOCK)
_MARKERS = (fixed.CALLS_OPEN, fixed.TOOL_OPEN)
_CLOSINGS = (fixed.TOOL_CLOSE, fixed.CALLS_CLOSE)
#: Characters of a text read so far in which a closing tag may have begun.
_TAIL = max(map(len, _CLOSINGS)) - 1
_KINDS = {"message": "text", "usage": "usage", "finish": "finish", "dialogId": "dialogId"}


#: Token counts of a usage chunk, and where its object has them.
COUNTS = {
    "prompt_tokens": ("promptTokens",),
    "completion_tokens": ("completionTokens",),
    "total_tokens": ("totalTokens",),
    "reasoning_tokens": ("nativeUsage", "completion_tokens_details", "reasoning_tokens"),
}


def _count(data, path: tuple[str, ...]) -> int:
    for name in path:
        data = data.get(name) if isinstance(data, dict) else None
    return int(data) if isinstance(data, (int, float)) else 0


def _no_constant(name):
    raise ValueError(name)


class LineReader:
    """Event lines to (type, content): the event name holds until the next event line."""

    def __init__(self, state: dict):
        self.state = state
        self.usage: dict[str, int] | None = None  # counts of the chunk read last

    def read(self, line: str) -> tuple[str, str | None] | None:
        self.usage = None
        line = line.strip(fixed.WHITESPACE)
        if line.startswith("event:"):
            self.state["event"] = line[6:].strip(fixed.WHITESPACE)
            return None
        if not line.startswith("data:"):
            return None
        try:
            data = json.loads(line[5:], parse_constant=_no_constant)
        except ValueError:
            return None
        kind = _KINDS.get(self.state.get("event", ""))
        if kind is None or data is None:
            return None
        if kind == "usage":
            self.usage = {name: _count(data, path) for name, path in COUNTS.items()}
        content = data.get("content") if isinstance(data, dict) and kind in ("text", "dialogId") else None
        if kind == "text":
            content = "" if content is None else content
        if isinstance(content, str) or content is None:
            return kind, content
        return kind, json.dumps(content, ensure_ascii=False, separators=(",", ":"))


class AnswerReader:
    """Chunks to reasoning text and answer text; a response may hold one of them back."""

    def __init__(self, state: dict):
        self.state = state

    def read(self, text: str) -> tuple[str, str, bool]:
        """(reasoning, answer, past): past is true for chunks after the reasoning."""
        text, phase = text.replace("\0", ""), self.state.get("phase")
        if phase is None and text:
            opened = self.state["opened"] = fixed.THINK_OPEN in text
            phase = self.state["phase"] = "reasoning" if opened else "answer"
            text = text.replace(fixed.THINK_OPEN, "", 1) if opened else text
        if phase == "reasoning":
            inner, close, rest = text.partition(fixed.THINK_CLOSE)
            if close:
                self.state["phase"] = "answer"
            return inner, rest.lstrip(fixed.WHITESPACE), False
        return "", _BLOCK.sub("", text).partition(fixed.THINK_OPEN)[0], True


class Pieces:
    """Texts that grow with a response, by name, piece after piece, kept in the state itself."""

    def __init__(self, state: dict):
        self.kept = state.setdefault("pieces", {})

    def add(self, name: str, text: str) -> None:
        if text:
            self.kept.setdefault(name, []).append(text)

    def take(self, name: str) -> str:
        return "".join(self.kept.pop(name, []))


class NoPieces:
    """For readers that need to know where texts end, not what they say."""

    def add(self, name: str, text: str) -> None:
        pass


class MarkerReader:
    """Answer text to text that may be sent on, and the tool buffer from a marker on.

    Of the buffer only its end is looked at again, as far as a closing tag may have begun there.
    """

    def __init__(self, state: dict, holdback: int = fixed.MARKER_HOLDBACK, pieces=None):
        self.state, self.holdback = state, holdback
        self.pieces = Pieces(state) if pieces is None else pieces

    @staticmethod
    def _marker(text: str) -> int:
        found = [at for at in map(text.find, _MARKERS) if at >= 0]
        return min(found, default=-1)

    def read(self, text: str, past: bool) -> str:
        if self.open:
            self._keep(text)
            return ""
        pending = self.state.get("pending", "") + text
        if not past or not text:  # text from the closing chunk is looked at with the next one
            self.state["pending"] = pending
            return ""
        return self._send(pending, max(len(pending) - self.holdback, 0))

    def finish(self) -> str:
        pending = self.state.get("pending", "")
        return self._send(pending, len(pending)) if pending else ""

    def _send(self, pending: str, ready: int) -> str:
        at = self._marker(pending)
        if at >= 0:
            self.state["tail"] = self.state["pending"] = ""
            self._keep(pending[at:])
            return pending[:at]
        self.state["pending"] = pending[ready:]
        return pending[:ready]

    def _keep(self, text: str) -> None:
        self.pieces.add("buffer", text)
        seen = self.state["tail"] + text
        self.state["closed"] = self.closed or any(tag in seen for tag in _CLOSINGS)
        self.state["tail"] = seen[-_TAIL:]

    @property
    def open(self) -> bool:
        return "tail" in self.state

    @property
    def closed(self) -> bool:
        return self.state.get("closed", False)


class SegmentReader:
    """Chunks of one response to (kind, text) segments.

    `separate` gives reasoning as it comes, `strip` none of it, `passthrough` all of it
    at once, tagged, in front of the answer.
    """

    def __init__(self, state: dict, holdback: int = fixed.MARKER_HOLDBACK, mode: str = "separate", pieces=None):
        if mode not in ("passthrough", "strip", "separate"):
            raise ValueError(f"unknown mode {mode!r}")
        self.state, self.mode = state, mode
        self.pieces = Pieces(state) if pieces is None else pieces
        self.answer, self.marker = AnswerReader(state), MarkerReader(state, holdback, self.pieces)

    def read(self, kind: str, content: str | None) -> list[tuple[str, str]]:
        out = []
        if kind == "text":
            reasoning, answer, past = self.answer.read(content or "")
            out = [*self._reasoning(reasoning), ("answer", self.marker.read(answer, past))]
        elif kind == "finish":
            out = [*self._reasoning("", ended=True), ("answer", self.marker.finish()), ("tool_buffer", self.pieces.take("buffer"))]
            self.state["done"] = True
        return [(k, t) for k, t in out if t]

    def _reasoning(self, text: str, ended: bool = False) -> list[tuple[str, str]]:
        if self.mode != "passthrough":
            return [("reasoning", text)] if self.mode == "separate" else []
        if not self.state.get("opened") or self.state.get("shown"):
            return []
        self.pieces.add("why", text)
        if self.state["phase"] == "reasoning" and not ended:
            return []
        self.state["shown"] = True
        return [("answer", fixed.THINK_OPEN + self.pieces.take("why") + fixed.THINK_CLOSE)]


class CutReader:
    """Chunks of one response to a report on the early cut, given at its finish chunk."""

    def __init__(self, state: dict):
        self.state = state
        self.answer, self.marker = AnswerReader(state), MarkerReader(state, pieces=NoPieces())

    def read(self, seq: int, kind: str, content: str | None) -> dict | None:
        state = self.state
        if kind == "text":
            _, answer, past = self.answer.read(content or "")
            if "cut_seq" in state:
                state["lost"] += len(answer)
                return None
            state["kept"] = state.get("kept", 0) + len(answer)
            opened = self.marker.open
            self.marker.read(answer, past)
            if opened and past and answer and self.marker.closed:
                state.update(cut_seq=seq, lost=0, usage_lost=False, pending="")
        elif kind == "usage" and "cut_seq" in state:
            state["usage_lost"] = True
        elif kind == "finish":
            state["done"] = True
            if "cut_seq" in state:
                return {
                    "cut_seq": state["cut_seq"], "kept_chars": state["kept"],
                    "lost_chars": state["lost"], "usage_lost": state["usage_lost"],
                }
        return None


class InOrder:
    """Rows of one key in the order of their numbers 0, 1, 2, ...: early ones wait, old ones drop."""

    def __init__(self, state: dict):
        self.state = state

    def add(self, rows: list[tuple]) -> None:
        held, due = self.state.setdefault("held", {}), self.state.setdefault("next", 0)
        for number, *row in rows:
            if number >= due:
                held[str(number)] = row

    def ready(self, all_held: bool = False):
        held = self.state["held"]
        while held:
            number = self.state["next"]
            if str(number) not in held:
                if not all_held:
                    return
                number = min(map(int, held))
            self.state["next"] = number + 1
            yield number, *held.pop(str(number))

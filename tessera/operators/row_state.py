"""The state machine of conditional mutations: one row's checked cells.

A request names a checked cell, the value it expects there (null: absent), a
version and a list of mutations of any cells of the same row. It is accepted if
the cell holds what it expects and its version is newer than the cell's last
change; then all its mutations apply at its version. An older request is
*stale*: the store would hide what it writes, so it is refused.

The mutations of one request share a version and act as the store resolves
them: increments, then puts (of several to one cell the greatest value), then
deletes, which cover all that has their ``ts`` or an older one.
"""

from __future__ import annotations

from collections.abc import Iterable

MAX_SEQ = (1 << 63) - 1
_ORDER = {"increment": 0, "put": 1}


def as_number(text: str | None) -> int:
    """The 64-bit number that a text is; 0 if it is none."""
    try:
        n = int(text) if text is not None else 0
    except ValueError:
        return 0
    return n if -(1 << 63) <= n < 1 << 63 else 0


class RowState:
    """Values and versions of a row's cells.

    ``closed`` states know every cell that some request checks from the start
    (:meth:`seed`); other cells don't matter to them. Open ones look a cell up
    (:meth:`load`) when a request first meets it.
    """

    def __init__(self, closed: bool = True):
        self.closed = closed
        #: (family, qualifier) -> (present, value, (ts, seq) of the last change or None)
        self.cells: dict[tuple[str, str], tuple] = {}
        self.row_tomb: int | None = None
        self.family_tombs: dict[str, int] = {}

    def seed(self, family: str, qualifier: str, present: bool, value: str | None, ts: int | None, seq: int | None) -> None:
        self.cells[family, qualifier] = present, value, None if ts is None else (ts, seq)

    def load(self, family: str, qualifier: str) -> tuple | None:
        """What is known of a cell that this object hasn't met."""
        return None

    def family_tomb(self, family: str) -> int | None:
        return self.family_tombs.get(family)

    def cell(self, family: str, qualifier: str) -> tuple:
        """The cell as it is; tombstones over it hide what is older."""
        if (found := self.cells.get((family, qualifier))) is None:
            found = self.load(family, qualifier) or (False, None, None)
            tombs = [t for t in (self.row_tomb, self.family_tomb(family)) if t is not None]
            if tombs and (found[2] is None or found[2] <= (max(tombs), MAX_SEQ)):
                found = False, None, (max(tombs), MAX_SEQ)
            self.cells[family, qualifier] = found
        return found

    def request(self, family: str, qualifier: str, expected: str | None, ts: int, seq: int, then: Iterable[dict]) -> bool:
        """Whether the request is accepted; if so, the state has changed."""
        present, value, last = self.cell(family, qualifier)
        if (last is not None and (ts, seq) <= last) or present != (expected is not None) or (present and value != expected):
            return False
        for m in sorted(then, key=lambda m: (_ORDER.get(m["kind"], 2), m["value"] or "")):
            self._apply(m, ts, seq)
        return True

    def _apply(self, m: dict, ts: int, seq: int) -> None:
        kind, at = m["kind"], (m["family"], m["qualifier"])
        if kind in ("put", "increment", "delete_cell"):
            if self.closed and at not in self.cells:
                return
            present, value, last = self.cell(*at)
            if kind == "delete_cell":
                self._hide([at], ts)
            elif last is None or (ts, seq) >= last:
                new = m["value"] if kind == "put" else str((as_number(value) if present else 0) + m["delta"])
                self.cells[at] = True, new, (ts, seq)
        elif kind == "delete_family":
            self.family_tombs[at[0]] = max(ts, self.family_tombs.get(at[0], ts))
            self._hide([k for k in self.cells if k[0] == at[0]], ts)
        elif kind == "delete_row":
            self.row_tomb = ts if self.row_tomb is None else max(self.row_tomb, ts)
            self._hide(list(self.cells), ts)

    def _hide(self, keys: list[tuple[str, str]], ts: int) -> None:
        for k in keys:
            last = self.cells[k][2]
            if last is None or last[0] <= ts:
                self.cells[k] = False, None, (ts, MAX_SEQ)

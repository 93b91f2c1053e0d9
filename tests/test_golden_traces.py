"""The window traces of FIXTURES.md §4, replayed through the trigger rule."""

import re
from pathlib import Path

import pytest

from millrace.operators import triggers as T

FIXTURES = Path(__file__).parent.parent / "FIXTURES.md"
SECOND = 1_000_000
SIZE = 10 * SECOND

S = SECOND
TRIGGERS = {
    "G01": (T.default_trigger(), 3),
    "G02": (T.default_trigger(), 3),
    "G03": (T.default_trigger(), 5),
    "G04": (T.default_trigger(), 5),
    "G05": (T.default_trigger(), 5),
    "G06": (T.default_trigger(), 5),
    "G07": (T.or_finally(T.AfterCount(2)), 5),
    "G08": (T.or_finally(T.AfterCount(2)), 5),
    "G09": (T.repeatedly(T.AfterFirst((T.AfterCount(3), T.AfterDelay(2 * S)))), 5),
    "G10": (T.repeatedly(T.AfterEach((T.AfterCount(3), T.AfterDelay(2 * S), T.AfterCount(1), T.PastEnd()))), 5),
    "G11": (T.after_watermark(T.AfterDelay(5 * S), T.AfterCount(3)), 5),
    "G12": (T.after_watermark(T.AfterDelay(3 * S), T.AfterEach((T.AfterCount(3), T.AfterCount(1)))), 5),
}
ACCUMULATING = {"G05", "G06"}


def traces():
    text = FIXTURES.read_text().split("## 4. Golden window traces")[1]
    for block in text.split("### ")[1:]:
        lines = block.splitlines()
        script = next(line for line in lines if line.startswith("- Script:"))[10:].strip()
        panes = next(line for line in lines if line.startswith("- Panes:"))[9:].strip()
        dropped = next(line for line in lines if line.startswith("- Dropped:"))[11:].strip()
        yield block[:3], script, panes, dropped


def us(text):
    return T.END_OF_TIME if text == "∞" else round(float(text) * SECOND)


def run(script, trigger, lateness, accumulating):
    folds, fired, dropped = {}, [], []
    now, watermark = 0, T.NO_WATERMARK
    seen: dict = {}

    def note(start, panes):
        for pane in panes:
            items = [x for part in pane.items for x in part]
            if accumulating:
                items = seen.setdefault(start, []) + items
                seen[start] = items
            fired.append((start // SECOND, pane.index, pane.timing, items))

    for step in script.split("; "):
        if step.startswith("add "):
            arrived: dict = {}
            for part in step[4:].split(", "):
                name, at = part.rsplit("@", 1)
                arrived.setdefault(us(at) // SIZE * SIZE, []).append(name)
            for start in sorted(arrived):
                fold = folds.get(start)
                if fold is None:
                    fold = folds[start] = T.WindowFold(trigger, start + SIZE, lateness * SECOND)
                    fold.advance_clock(now)
                    fold.advance_watermark(watermark)
                before = (fold.state.count, fold.state.index)
                panes = fold.add(arrived[start], len(arrived[start]))
                if not panes and (fold.state.count, fold.state.index) == before:
                    dropped += arrived[start]
                note(start, panes)
        elif step.startswith("wm="):
            watermark = us(step[3:])
            for start, fold in sorted(folds.items()):
                note(start, fold.advance_watermark(watermark))
        else:
            now += us(step[3:])
            for start, fold in sorted(folds.items()):
                note(start, fold.advance_clock(now))
    return fired, dropped


@pytest.mark.parametrize("name,script,panes,dropped", list(traces()), ids=lambda v: v if len(v) == 3 else "")
def test_trace(name, script, panes, dropped):
    trigger, lateness = TRIGGERS[name]
    fired, lost = run(script, trigger, lateness, name in ACCUMULATING)
    expected = []
    for part in panes.split("; "):
        start, index, timing, items = re.match(r"\[(\d+), (\d+), (\w+)\] (.*)", part).groups()
        expected.append((int(start), int(index), timing, items.split(", ")))
    assert fired == expected
    assert lost == dropped.split(", ")

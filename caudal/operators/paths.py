"""Regular expressions over the events of a user and day, in order of time.

A pattern over step letters becomes an automaton. What a stretch of events does to it is a map from states to
states, and maps of stretches that follow one another are composed, in whatever order that is done. Events are
therefore dealt out by user, day and time in ranges: a busy day is cut between tasks, each composes the maps of its
own events, and a user-day's maps, one from each task that has some of it, are composed at the end. No user-day is
gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial
from re import _parser as parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.time import day_text, instant
from caudal.operators.sessions import EVENT_IDS

#: An automaton has at most so many states: a map is as many bytes.
STATES = 256
#: Marks before and behind a text, which no letter is.
BEGIN, END = "\x02", "\x03"


class Automaton(NamedTuple):
    """``moves[letter]`` maps each state to the next; state 0 is the first."""

    letters: str
    moves: np.ndarray
    accepting: frozenset[int]


class _Net:
    """Places with arrows that take one of some letters, or nothing (None)."""

    def __init__(self, letters: str) -> None:
        self.letters = frozenset(letters)
        self.arrows: list[list[tuple[frozenset[str] | None, int]]] = []

    def place(self) -> int:
        self.arrows.append([])
        return len(self.arrows) - 1

    def chars(self, code: str, value: object) -> frozenset[str]:
        if code == "LITERAL":
            return self.letters & {chr(value)}
        if code == "NOT_LITERAL":
            return self.letters - {chr(value)}
        if code == "ANY":
            return self.letters
        if code == "RANGE":
            return frozenset(c for c in self.letters if value[0] <= ord(c) <= value[1])
        if code == "IN":
            negated = str(value[0][0]) == "NEGATE"
            found = frozenset().union(*(self.chars(str(c), v) for c, v in value[negated:]))
            return self.letters - found if negated else found
        if code == "AT" and value in (parser.AT_BEGINNING, parser.AT_END):
            return frozenset([BEGIN if value == parser.AT_BEGINNING else END])
        raise ValueError(f"{code} is not known in patterns over events")

    def draw(self, items: list, at: int) -> int:
        """Draw the items from a place on; the place they end in."""
        for code, value in items:
            at = self._one(str(code), value, at)
        return at

    def _one(self, code: str, value: object, at: int) -> int:
        if code == "SUBPATTERN":
            return self.draw(list(value[3]), at)
        if code == "BRANCH":
            end = self.place()
            for branch in value[1]:
                self.arrows[self.draw(list(branch), at)].append((None, end))
            return end
        if code in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, items = value
            for _ in range(least):
                at = self.draw(list(items), at)
            if most == parser.MAXREPEAT:
                loop, end = self.place(), self.place()
                self.arrows[at].append((None, loop))
                self.arrows[self.draw(list(items), loop)].append((None, loop))
                self.arrows[loop].append((None, end))
                return end
            end = self.place()
            for _ in range(most - least):
                self.arrows[at].append((None, end))
                at = self.draw(list(items), at)
            self.arrows[at].append((None, end))
            return end
        end = self.place()
        self.arrows[at].append((self.chars(code, value), end))
        return end

    def reached(self, places: set[int]) -> frozenset[int]:
        todo, found = list(places), set(places)
        while todo:
            for taken, to in self.arrows[todo.pop()]:
                if taken is None and to not in found:
                    found.add(to)
                    todo.append(to)
        return frozenset(found)


def automaton(pattern: str, letters: str) -> Automaton:
    """The automaton that finds ``pattern`` in a text of ``letters``, as ``re.search`` does.

    Letters, ``.``, sets, groups, ``|``, all repeats, ``^`` and ``$`` are known. The two anchors are marks before and
    behind the text: state 0 has taken the first one, and a state accepts if it finds the pattern once it takes the last.
    """
    net = _Net(letters)
    marked = net.letters | {BEGIN, END}
    start = net.place()
    net.arrows[start].append((marked, start))
    goal = net.draw(list(parser.parse(pattern)), start)
    found = frozenset([goal])

    def step(state: frozenset[int], letter: str) -> frozenset[int]:
        to = net.reached({p for place in state for taken, p in net.arrows[place] if taken and letter in taken})
        return found if goal in state or goal in to else to

    first = net.reached({start})
    numbers = {step(first, BEGIN): 0}
    moves: list[list[int]] = []
    for state in (todo := list(numbers)):
        row = []
        for letter in letters:
            to = step(state, letter)
            if to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
                if len(numbers) > STATES:
                    raise ValueError(f"the pattern needs more than {STATES} states")
            row.append(numbers[to])
        moves.append(row)
    return Automaton(letters, np.array(moves, np.uint8).T, frozenset(n for state, n in numbers.items() if goal in step(state, END)))


def compose(maps: np.ndarray, group: np.ndarray) -> np.ndarray:
    """One map for each run of equal groups: the maps of the run, first to last. Neighbours are joined in pairs."""
    while True:
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        if len(starts) == len(group):
            return maps
        nth = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        left = np.flatnonzero(nth % 2 == 0)
        paired = left[(left + 1 < len(group)) & (group[np.minimum(left + 1, len(group) - 1)] == group[left])]
        maps = maps.copy()
        maps[paired] = np.take_along_axis(maps[paired + 1], maps[paired].astype(np.intp), axis=1)
        maps, group = maps[left], group[left]


def _stretch_maps(moves: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The map of each user-day's events in a partition, with the first of them. Rows come in order."""
    held: pa.Table | None = None
    held_map = np.zeros((0, moves.shape[1]), np.uint8)
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = pa.Table.from_batches([batch]).select(["userid", "day", "at"])
        users, days = keys["userid"].combine_chunks(), keys["day"].combine_chunks()
        group = np.zeros(len(keys), np.int64)
        if len(keys) > 1:
            new = [pc.fill_null(pc.not_equal(c[1:], c[:-1]), True).to_numpy(zero_copy_only=False) for c in (users, days)]
            # two nulls in a row are one user
            null = pc.and_(users[1:].is_null(), users[:-1].is_null()).to_numpy(zero_copy_only=False)
            group[1:] = np.cumsum((new[0] & ~null) | new[1])
        maps = compose(moves[batch["letter"].to_numpy()], group)
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        firsts = keys.take(pa.array(starts))
        if held is not None:
            same = all(held[c][0].as_py() == firsts[c][0].as_py() for c in ("userid", "day"))
            if same:
                maps[0] = maps[0][held_map[0]]
                firsts = pa.concat_tables([held, firsts.slice(1)])
            else:
                firsts, maps = pa.concat_tables([held, firsts]), np.concatenate((held_map, maps))
        yield from _map_rows(firsts.slice(0, len(maps) - 1), maps[:-1])
        held, held_map = firsts.slice(len(maps) - 1), maps[-1:]
    if held is not None:
        yield from _map_rows(held, held_map)


def _map_rows(keys: pa.Table, maps: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(keys):
        column = pa.array([m.tobytes() for m in maps], pa.binary())
        yield from keys.append_column("map", column).combine_chunks().to_batches()


def match_days(
    hits: DataFrame,
    pattern: str,
    *,
    user: str = "userid",
    timestamp: str = "timestamp",
    event: str = "event",
    sequence: str | None = None,
    events: Mapping[str, str] = EVENT_IDS,
) -> DataFrame:
    """User-days (userid, day) in whose events, written as step letters in order, ``pattern`` is found.

    ``events`` names the event of each letter; other events are passed over, and a day that has no other is no
    user-day. ``sequence`` orders hits of equal time, which come in the order of their letters without it. Hits
    without a readable time are left out; a null user is a user.
    """
    letters = "".join(sorted(events))
    machine = automaton(pattern, letters)
    at = instant(hits, timestamp)
    number: Column = F.lit(None).cast("int")
    for n, letter in enumerate(letters):
        number = F.when(F.col(event) == events[letter], n).otherwise(number)
    place = F.col(sequence) if sequence else number
    rows = hits.select(
        F.col(user).alias("userid"), day_text(at).alias("day"), F.struct(at.alias("time"), place.alias("place")).alias("at"), number.alias("letter")
    ).where(F.col("at.time").isNotNull() & F.col("letter").isNotNull())
    parts = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges of time inside a user-day, so that a busy one is cut; equal rows stay together
    dealt = rows.repartitionByRange(parts, "userid", "day", "at").sortWithinPartitions("userid", "day", "at", "letter")
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"userid {types['userid']}, day string, at {types['at']}, map binary"
    stretches = dealt.mapInArrow(partial(_stretch_maps, machine.moves), schema)
    # one map from each task that has some of the user-day, in order of time
    days = stretches.groupBy("userid", "day").agg(F.sort_array(F.collect_list(F.struct("at", "map"))).alias("maps"))
    byte = lambda m, state: F.conv(F.hex(F.substring(m, state + 1, F.lit(1))), 16, 10).cast("int")
    end = F.aggregate("maps", F.lit(0), lambda state, stretch: byte(stretch["map"], state))
    return days.where(end.isin(sorted(machine.accepting))).select("userid", "day")

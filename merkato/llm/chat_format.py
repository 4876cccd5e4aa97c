"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is lines of text, some with a speaker marker ("User:", "[assistant]", "**System**:"). The hidden
state of a line is its role and whether it begins a turn; a line shows its marker, whether it is blank, how
long it is and whether it ends in a question. Start, transition and emission counts come from all lines
whose role is known, with one added to each, and a marker's own role weighted as ``MARKER_TRUST`` lines would. The most
likely states (Viterbi) give the roles; turns are then rendered with their markers taken off.

Lines are range-partitioned in transcript order. A transcript inside one slice is decoded there. One that spans
slices (it may hold a third of all lines) is cut at the slices: each part gives its best score from every state to
every state, one row per part is chained per transcript, and each part is then decoded on its own between its
two known ends.

Defined cases: a null text is one blank line; a null transcript id is a transcript of its own; repeated rows are
lines of their own, in order of text; a null role is not learned from; without any known role the roles are user,
assistant and system; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merkato.functions.ordering import neighbour
from merkato.llm.common import ship, store

#: Names that stand before a speaker's lines, by role.
SPEAKERS = {
    "user": ("user", "human", "customer", "you", "q"),
    "assistant": ("assistant", "ai", "bot", "agent", "model", "a"),
    "system": ("system", "instructions", "prompt"),
}
MARKER = r"^\s*(?:[#>*_\[(<|]+\s*)?(" + "|".join(
    n for names in SPEAKERS.values() for n in names) + r")\s*(?:[\])>|*_]*\s*:|[\])>|]+)[*_]*\s*"
MARKER_TRUST = 50
LENGTHS = (0, 20, 60, 150, 400)  # bounds of the length classes, in code points
ORDER = ["turn", "line", "text"]


def marker_role(text: Column) -> Column:
    """The role whose marker begins the line, "" without one."""
    name = F.lower(F.regexp_extract(text, f"(?i){MARKER}", 1))
    role = F.when(name == "", F.lit(""))
    for kept, names in SPEAKERS.items():
        role = role.when(name.isin(*names), F.lit(kept))
    return role.otherwise(F.lit(""))


def seen(text: Column) -> Column:
    """What a line shows, as one small text: marker, length class, question."""
    size = F.char_length(F.trim(text))
    length = sum(((size > bound).cast("int") for bound in LENGTHS), F.lit(0))
    return F.concat_ws("|", marker_role(text), length.cast("string"), F.rtrim(text).endswith("?").cast("int").cast("string"))


def transcript_lines(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, line, text, role, begins)`` from rows ``(conv_id, turn, role, text)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return turns.select("conv_id", "turn", "role", F.posexplode(F.split(text, "\n")).alias("line", "text")).withColumn(
        "begins", F.col("line") == 0)


class Model:
    """Log scores of start, transition and emission."""

    def __init__(self, roles: list[str], starts, moves, shows):
        self.roles = roles
        self.states = [(r, b) for r in roles for b in (True, False)]
        place = {s: k for k, s in enumerate(self.states)}
        n = len(self.states)
        start, move = np.ones(n), np.ones((n, n))
        for role, begins, count in starts:
            start[place[role, begins]] += count
        for before, began, role, begins, count in moves:
            move[place[before, began], place[role, begins]] += count
        for a, (r, _) in enumerate(self.states):
            for b, (s, begins) in enumerate(self.states):
                if r != s and not begins:
                    move[a, b] = 1e-9  # a role changes only where a turn begins
            start[a] = start[a] if self.states[a][1] else 1e-9
        kinds = sorted({what for _, _, what, _ in shows})
        self.column = {what: k for k, what in enumerate(kinds)}
        emit = np.ones((n, len(kinds) + 1))
        for role, begins, what, count in shows:
            emit[place[role, begins], self.column[what]] += count
        self.start = np.log(start / start.sum())
        self.move = np.log(move / move.sum(axis=1, keepdims=True))
        self.emit = np.log(emit / emit.sum(axis=1, keepdims=True))
        begins = np.array([b for _, b in self.states])
        self.marked = {}
        for role in roles:  # as if the role had begun so many turns with its marker
            own = np.array([r == role for r, _ in self.states])
            self.marked[role] = np.where(own & begins, np.log(MARKER_TRUST), 0.0) - np.where(own & begins, 0.0, np.log(MARKER_TRUST))

    def emissions(self, shown) -> np.ndarray:
        rest = self.emit.shape[1] - 1
        scores = self.emit[:, [self.column.get(w, rest) for w in shown]].T.copy()
        for k, what in enumerate(shown):
            extra = self.marked.get(what.split("|")[0])
            if extra is not None:
                scores[k] += extra
        return scores

    def viterbi(self, shown, entry: int = -1, leave: int = -1) -> np.ndarray:
        """Best states; ``entry`` is the state before (-1: the transcript starts), ``leave`` the last state (-1: any)."""
        emissions = self.emissions(shown)
        score = (self.start if entry < 0 else self.move[entry]) + emissions[0]
        back = np.zeros(emissions.shape, np.int64)
        for k in range(1, len(emissions)):
            through = score[:, None] + self.move
            back[k] = through.argmax(axis=0)
            score = through.max(axis=0) + emissions[k]
        path = np.empty(len(emissions), np.int64)
        path[-1] = score.argmax() if leave < 0 else leave
        for k in range(len(emissions) - 1, 0, -1):
            path[k - 1] = back[k, path[k]]
        return path

    def transfer(self, shown, first: bool) -> np.ndarray:
        """Best score from every state before the lines to every state at their end."""
        emissions = self.emissions(shown)
        total = (np.tile(self.start, (len(self.states), 1)) if first else self.move) + emissions[0]
        for row in emissions[1:]:
            total = (total[:, :, None] + self.move[None]).max(axis=1) + row
        return total


def fit(lines: DataFrame) -> Model:
    """Counts over all lines with a known role. The driver gets one row per pair of states, and per state and look."""
    known = lines.where("role IS NOT NULL").select("conv_id", *ORDER, "role", "begins")
    shows = known.groupBy("role", "begins", seen(F.col("text")).alias("shown")).count().collect()
    pairs = neighbour(known, ["conv_id"], ORDER, ["role", "begins"], -1)
    moves = pairs.groupBy("prev_role", "prev_begins", "role", "begins").count().collect()
    roles = sorted({r.role for r in shows}) or sorted(SPEAKERS)
    return Model(
        roles, [(r.role, r.begins, r["count"]) for r in moves if r.prev_role is None],
        [(r.prev_role, r.prev_begins, r.role, r.begins, r["count"]) for r in moves if r.prev_role is not None],
        [(r.role, r.begins, r.shown, r["count"]) for r in shows])


def decode(lines: DataFrame, model: Model) -> DataFrame:
    """Add ``recovered`` (the role) and ``opens`` (a turn begins here) to lines."""
    order = ["conv_id", *ORDER]
    ranged = lines.withColumn("shown", seen(F.col("text"))).repartitionByRange(*order).sortWithinPartitions(*order)
    sliced = store(ranged.withColumn("slice", F.spark_partition_id()).withColumn(
        "at", F.monotonically_increasing_id()), "transcript-lines")
    parts = sliced.groupBy("conv_id").agg(F.min("slice").alias("first"), F.max("slice").alias("last"))
    parts = store(parts.where("first < last").select(F.col("conv_id").alias("long_id"), "first"), "long-transcripts")
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    found = "at long, state int"

    def whole(batches):
        """Rows in order, transcript by transcript; no more than one transcript waits for its end."""
        waiting: list[pd.DataFrame] = []
        made: list[pd.DataFrame] = []

        def decoded():
            rows = pd.concat(waiting)
            return pd.DataFrame({"at": rows["at"], "state": model.viterbi(rows.shown.tolist())})

        for batch in batches:
            names = batch["name"].fillna("").tolist()
            if not names:
                continue
            edges = [0, *[k for k in range(1, len(names)) if names[k] != names[k - 1]], len(names)]
            for first, last in zip(edges, edges[1:], strict=False):
                if waiting and names[first] != waiting[-1]["name"].iloc[-1]:
                    made.append(decoded())
                    waiting = []
                waiting.append(batch.iloc[first:last].fillna({"name": ""}))
            if made:
                yield pd.concat(made)
                made = []
        if waiting:
            yield decoded()

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        shown = rows.sort_values("at").shown.tolist()
        first = rows["slice"].iloc[0] == rows["first"].iloc[0]
        return pd.DataFrame({"conv_id": [rows.conv_id.iloc[0]], "slice": [rows["slice"].iloc[0]],
                             "scores": [model.transfer(shown, first).ravel().tolist()]})

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slice")
        n, before, reached = len(model.states), None, []
        for scores in rows.scores:
            scores = np.array(scores).reshape(n, n)
            before = scores[0] if before is None else (before[:, None] + scores).max(axis=0)
            reached.append((before, scores))
        leave, states = int(reached[-1][0].argmax()), []
        for k in range(len(reached) - 1, -1, -1):
            entry = -1 if k == 0 else int((reached[k - 1][0] + reached[k][1][:, leave]).argmax())
            states.append((entry, leave))
            leave = entry
        states.reverse()
        return pd.DataFrame({"conv_id": rows.conv_id, "slice": rows["slice"],
                             "entry": [s[0] for s in states], "leave": [s[1] for s in states]})

    def between(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        states = model.viterbi(rows.shown.tolist(), int(rows.entry.iloc[0]), int(rows.leave.iloc[0]))
        return pd.DataFrame({"at": rows["at"], "state": states})

    # An id as text never is the empty one that stands for null.
    short = sliced.join(parts, is_long, "left_anti").select(F.col("conv_id").cast("string").alias("name"), "slice", "at", "shown")
    long = store(sliced.join(parts, is_long).select("conv_id", "slice", "first", "at", "shown"), "long-lines")
    states = short.repartition("slice").sortWithinPartitions("at").mapInPandas(whole, found)
    scores = long.groupBy("conv_id", "slice").applyInPandas(part, "conv_id long, slice int, scores array<double>")
    ends = store(scores.groupBy("conv_id").applyInPandas(chain, "conv_id long, slice int, entry int, leave int"), "ends")
    same = F.col("conv_id").eqNullSafe(F.col("end_id")) & (F.col("slice") == F.col("end_slice"))
    bound = long.join(ends.select(F.col("conv_id").alias("end_id"), F.col("slice").alias("end_slice"), "entry", "leave"), same)
    states = states.unionByName(bound.groupBy("conv_id", "slice").applyInPandas(between, found))
    names = F.array(*[F.lit(r) for r, _ in model.states])
    named = states.select("at", F.element_at(names, F.col("state") + 1).alias("recovered"), (F.col("state") % 2 == 0).alias("opens"))
    return sliced.join(named, "at").select(*lines.columns, "recovered", "opens")


def rendered(text: Column, role: Column, opens: Column) -> Column:
    """A line in canonical form: the role's tag before a turn, and no marker."""
    plain = F.regexp_replace(text, f"(?i){MARKER}", "")
    return F.when(opens, F.concat(F.lit("<|"), role, F.lit("|>\n"), plain)).otherwise(text)


def format_lines(lines: DataFrame, model: Model | None = None) -> DataFrame:
    """Lines with ``recovered``, ``opens`` and ``canonical``; the model is fitted on the lines themselves if none is given."""
    decoded = decode(lines, model or fit(lines))
    return decoded.withColumn("canonical", rendered(F.col("text"), F.col("recovered"), F.col("opens")))


def with_markers(turns: DataFrame, of: int = 3) -> DataFrame:
    """Transcripts as people paste them: of ``of`` turns, one (by a hash) has lost its marker."""
    kept = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(of)) != 0
    text = F.coalesce(F.col("text"), F.lit(""))
    return turns.withColumn("text", F.when(kept & F.col("role").isNotNull(), F.concat(
        F.initcap("role"), F.lit(": "), text)).otherwise(text))


ship(__name__)

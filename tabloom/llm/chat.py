"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only.

The turns of a conversation, in order, drive a machine whose moves the template lists. Every turn gives three segments: the
opening mark of its role, its text, and the closing mark; a segment of an assistant's text carries the loss. A turn without a move is a
fault: the conversation is not valid, is formatted all the same, and the machine goes on in the state that the role leads to first.

Control strings inside texts are cut by a backslash after their first character, and backslashes are doubled, so no text holds a
mark and ``unescape`` gives every text back. ``read_back`` finds the turns again in the formatted string alone.

Defined results: a null text is empty; a null role is the empty role, which like any role without marks of its own is written
out and is a fault; turns go by (turn, role, text), nulls first, so ties and repeated rows have one order; each row with a null conversation is
a conversation of its own; an empty table gives no rows; other columns are not read. A conversation is one example, hence one row: its turns
meet in one group, and its text must fit Spark's limit for a string.
"""

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.rows import column

CUT = "\\"


@dataclass(frozen=True)
class Turn:
    """Marks around the text of a role, and whether its text is learned."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, the control strings that they hold, and the machine: ``moves[state][role]`` is the next state."""

    begin: str
    turns: dict[str, Turn]
    other: tuple[str, str, str]         # before the name, between name and text, and after the text of any other role
    controls: tuple[str, ...]
    moves: dict[str, dict[str, str]]
    start: str
    final: tuple[str, ...]
    entry: dict[str, str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "entry", {r: s for moves in reversed(self.moves.values()) for r, s in moves.items()})
        if any(len(c) < 2 or CUT in c for c in self.controls):
            raise ValueError("a control string has two or more characters and no backslash")
        name, between, after = self.other
        before = [t.open for t in self.turns.values()] + [name, between]
        behind = [t.close for t in self.turns.values()] + [between, after]
        for mark in behind:
            if not any(c in mark for c in self.controls):
                raise ValueError(f"mark {mark!r} after a text holds no control string")
        opens = [*(t.open for t in self.turns.values()), name]
        if any(a != b and b.startswith(a) for a in opens for b in opens) or len(set(opens)) < len(opens):
            raise ValueError("an opening mark begins another one")
        for c in self.controls:
            for i in range(1, len(c)):
                head, tail = c[:i], c[i:]
                if any(m.startswith(tail) or tail.startswith(m) for m in behind) or any(m.endswith(head) or head.endswith(m) for m in before):
                    raise ValueError(f"control string {c!r} may arise where a text meets a mark")


INSTRUCT = Template(
    begin="<s>",
    turns={"system": Turn("<<SYS>>\n", "\n<</SYS>>\n"), "user": Turn("[INST] ", " [/INST]"), "assistant": Turn(" ", " </s>", loss=True)},
    other=("<<ROLE>> ", " <</ROLE>> ", " <<END>>"),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>", "<<END>>"),
    moves={"start": {"system": "told", "user": "asked"}, "told": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}},
    start="start",
    final=("answered",),
)


def literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def escape(text: Column, template: Template) -> Column:
    """Backslashes doubled, and one put after the first character of every control string."""
    starts = {}
    for c in template.controls:
        starts.setdefault(c[0], []).append(re.escape(c[1:]))
    pattern = "|".join(f"{re.escape(first)}(?={'|'.join(rest)})" for first, rest in starts.items())
    return F.regexp_replace(F.replace(text, F.lit(CUT), F.lit(CUT * 2)), pattern, "$0" + CUT * 2)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def run_machine(roles: Column, template: Template) -> Column:
    """struct(state, at, fault): the last state, the number of turns, and the place of the first turn without a move."""
    moves = literal_map({f"{state}>{role}": to for state, by_role in template.moves.items() for role, to in by_role.items()})
    entry = literal_map(template.entry)

    def step(seen, role):
        to = F.try_element_at(moves, F.concat(seen["state"], F.lit(">"), role))
        lost = to.isNull() & seen["fault"].isNull()
        return F.struct(F.coalesce(to, F.try_element_at(entry, role), seen["state"]).alias("state"), (seen["at"] + 1).alias("at"),
                        F.when(lost, seen["at"]).otherwise(seen["fault"]).alias("fault"))

    first = F.struct(F.lit(template.start).alias("state"), F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("fault"))
    return F.aggregate(roles, first, step)


def segments_of(turns: Column, template: Template) -> Column:
    """array of struct(text, loss): the beginning, then three segments a turn."""
    name, between, after = template.other
    opens, closes = (literal_map({r: getattr(t, side) for r, t in template.turns.items()}) for side in ("open", "close"))
    learned = F.array(*[F.lit(r) for r, t in template.turns.items() if t.loss])

    def segment(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    def emit(turn):
        written = F.concat(F.lit(name), escape(turn["role"], template), F.lit(between))
        return F.array(segment(F.coalesce(F.try_element_at(opens, turn["role"]), written), F.lit(False)),
                       segment(escape(turn["text"], template), F.array_contains(learned, turn["role"])),
                       segment(F.coalesce(F.try_element_at(closes, turn["role"]), F.lit(after)), F.lit(False)))

    return F.concat(F.array(segment(F.lit(template.begin), F.lit(False))), F.flatten(F.transform(turns, emit)))


def format_chats(rows: DataFrame, template: Template = INSTRUCT, conversation="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """The conversation, its segments (array of struct(text, loss)), and the machine's word on it: valid, complete, fault_turn.

    ``valid`` means that every turn had a move, ``complete`` that the last state is final as well; ``fault_turn`` is the
    place of the first turn without a move, counted from 0.
    """
    key = column(rows, conversation)
    said = F.struct(column(rows, turn).alias("turn"), F.coalesce(column(rows, role).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(column(rows, text).cast("string"), F.lit("")).alias("text"))
    turns = rows.select(key.alias("conv"), F.when(key.isNull(), F.monotonically_increasing_id()).alias("alone"), said.alias("said"))
    whole = turns.groupBy("conv", "alone").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    ran = whole.withColumn("ran", run_machine(F.transform("turns", lambda t: t["role"]), template))
    valid = F.col("ran.fault").isNull()
    return ran.select(F.col("conv").alias(conversation), segments_of(F.col("turns"), template).alias("segments"), valid.alias("valid"),
                      (valid & F.col("ran.state").isin(*template.final)).alias("complete"), F.col("ran.fault").alias("fault_turn"))


def joined(segments: Column) -> Column:
    """The formatted string."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """array of struct(role, text): the turns found in a formatted string."""
    name, between, after = template.other
    marks = [(r, t.open, t.close) for r, t in template.turns.items()] + [(None, name, after)]
    pattern = "|".join(f"{re.escape(a)}(?s:.*?){re.escape(b)}" for _, a, b in marks)
    found = F.regexp_extract_all(F.substr(formatted, F.lit(len(template.begin) + 1)), F.lit(pattern), F.lit(0))

    def inside(turn, a, b):
        return F.substr(turn, F.lit(len(a) + 1), F.length(turn) - (len(a) + len(b)))

    def parse(turn):
        rest = inside(turn, name, after)
        at = F.instr(rest, between)
        role, text = F.substr(rest, F.lit(1), at - 1), F.substr(rest, at + len(between))
        for known, a, b in marks[:-1]:
            here = turn.startswith(a)
            role, text = F.when(here, F.lit(known)).otherwise(role), F.when(here, inside(turn, a, b)).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(found, parse)


# Roles as one string of letters; the marks' lengths, and one cut a backslash and a control string, by role.
SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    regexp_replace(replace(coalesce(text, ''), '\', '\\'), '([<\[])(/?s>|/?INST\]|</?SYS>>|</?ROLE>>|<END>>)', '\1\\\2', 'g') AS escaped FROM rows),
sized AS (
  SELECT *, length(escaped) + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 30 + length(role) END AS size FROM said),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS learned, sum(size) + 3 AS formatted,
    string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'o' END, '' ORDER BY turn NULLS FIRST, role, text) AS roles
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
  CAST(formatted AS BIGINT) AS formatted_chars, regexp_full_match(roles, 's?(ua)*u?') AS valid, regexp_full_match(roles, 's?(ua)+') AS complete
FROM whole
"""

"""Chat formatting with a grammar round trip.

Grammar (every mark is followed or preceded by one space that belongs to it):

    turn      = system | user | assistant | other
    system    = "<<SYS>> " text " <</SYS>>"
    user      = "[INST] " text " [/INST]"
    assistant = "<s> " text " </s>"            (the text is the loss mask)
    other     = "[ROLE] " role " [/ROLE] " text " [/TURN]"

A mark inside a text is live unless backslashes stand before it. Escaping puts one
more backslash before each mark of a text, reading takes one away, so it is
reversible. Each turn is rendered as it is, parsed again, and compared to its source;
a conflicting text is escaped until the parse gives the source back.

Turns of a conversation are ordered by (turn, role, text). They stream through sorted
tasks one row at a time: a conversation of any size needs the memory of one turn.
Null texts and roles count as empty; rows with a null conversation id form one
conversation. Repeated rows are turns like any other. Empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN = {"system": "<<SYS>> ", "user": "[INST] ", "assistant": "<s> "}
CLOSE = {"system": " <</SYS>>", "user": " [/INST]", "assistant": " </s>"}
OTHER, OTHER_TEXT, OTHER_END = "[ROLE] ", " [/ROLE] ", " [/TURN]"
_MARK = (r"<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[/ROLE\]|\[/TURN\]")
_MARKS = re.compile(_MARK)
_LIVE = re.compile(rf"(?<!\\)(?:{_MARK})")
_ESCAPED = re.compile(rf"\\(\\*(?:{_MARK}))")
_TO_ESCAPE = re.compile(rf"(\\*(?:{_MARK}))")


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse_front(rendered: str) -> tuple[list[tuple[str, str]], int]:
    """(role, text) of the whole turns at the front, and where they end."""
    turns, at = [], 0

    def upto(close: str, start: int) -> tuple[str, int] | None:
        """The text from ``start`` to the next live mark, which must be that of ``close``."""
        mark = _LIVE.search(rendered, start)
        end = mark.start() - 1 if mark else -1
        if end < start or rendered[end:end + len(close)] != close:
            return None
        return unescape(rendered[start:end]), end + len(close)

    while at < len(rendered):
        for role, opening in OPEN.items():
            if rendered.startswith(opening, at):
                found = upto(CLOSE[role], at + len(opening))
                break
        else:
            named = upto(OTHER_TEXT, at + len(OTHER)) if rendered.startswith(OTHER, at) else None
            if named is None:
                break
            role, found = named[0], upto(OTHER_END, named[1])
        if found is None:
            break
        turns.append((role, found[0]))
        at = found[1]
    return turns, at


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """(role, text) of every turn; None where the grammar does not fit."""
    turns, end = parse_front(rendered)
    return turns if end == len(rendered) else None


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, and where its text begins and ends in it."""
    for shown_role, shown in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        opening = OPEN.get(role) or OTHER + shown_role + OTHER_TEXT
        rendered = opening + shown + (CLOSE.get(role) or OTHER_END)
        if parse(rendered) == [(role, text)]:
            return rendered, len(opening), len(opening) + len(shown)
    raise ValueError("a turn that cannot be read back")


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key: object = _format  # no conversation yet
    at = 0
    for batch in batches:
        rows = []
        for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
            if conv != key:
                key, at = conv, 0
            rendered, begin, end = render_turn(role, text)
            rows.append((rendered, at, at + begin, at + end, role == "assistant"))
            at += len(rendered)
        if rows:
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (
                pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols], names=[
                "conv_id", "turn", "role", "rendered", "start", "text_start", "text_end", "loss"])


def format_chats(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rendered turns in order, with code point positions inside their conversation.

    conv_id, turn, role, rendered, start, text_start, text_end, loss (whether the text
    is under the loss mask). Concatenated in the order given, the ``rendered`` of a
    conversation are its formatted text.
    """
    rows = convs.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((role_col, "role"), (text_col, "text"))))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_format, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, "
                            "rendered string, start long, text_start long, text_end long, loss boolean")


class _Conversation:
    """A conversation read back from its joined text, a piece at a time.

    Turns are parsed off the front of what has come, wherever the pieces were cut; the loss
    text is what the mask's positions say, read from the joined text alone.
    """

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.open = ""  # what is not parsed yet

    def add(self, rendered: str, begin: int, end: int, masked: bool) -> None:
        at = self.chars
        self.chars += len(rendered)
        if masked:  # positions in the conversation; what lies outside this piece is not there to read
            text = unescape(rendered[max(0, begin - at):max(0, end - at)])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.open += rendered
        found, done = parse_front(self.open)
        for role, text in found:
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        self.open = self.open[done:]

    def row(self) -> tuple:
        if self.open:
            raise ValueError("a conversation that cannot be read back")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key: object = _read
    state = _Conversation()
    done: list[tuple] = []

    def flush(kind: pa.DataType) -> pa.RecordBatch:
        cols = zip(*done, strict=True)
        types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, types, strict=True)],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, *piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != key:
                if key is not _read:
                    done.append((key, *state.row()))
                key, state = conv, _Conversation()
            state.add(*piece)
        if done:
            yield flush(kind)
            done.clear()
    if key is not _read:
        done.append((key, *state.row()))
        yield flush(kind)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the grammar and the loss mask read from the joined turns, one row per conversation."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "rendered", "text_start", "text_end", "loss").mapInArrow(
        _read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")


#: the conversation of the contract whose texts are all marks
PROBE = "</s>[INST] ok [/INST]"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    return read_back(format_chats(convs.unionByName(probe)))


ORACLE = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, len(regexp_extract_all(text,
    '<<SYS>>|<</SYS>>|\\[INST\\]|\\[/INST\\]|<s>|</s>|\\[ROLE\\]|\\[/ROLE\\]|\\[/TURN\\]')) AS marks FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(text) + marks + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
      ELSE 24 + length(role) END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

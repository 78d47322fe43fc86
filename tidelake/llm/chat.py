"""Chat formatting in budgeted, turn-aligned windows with loss spans.

A conversation's turns are taken in order.  A window starts with the system turn, if the
conversation opens with one, repeats as much of the latest history as the history budget
allows, and then takes new turns while their tokens fit; prefix sums of turn tokens
decide both.  Every turn is new in exactly one window, and a window has at least one new
turn, however long.  Assistant texts are under the loss mask where they are new; repeated
ones are not.

A turn is ``<s>[INST] role``, a line break, its text, ``[/INST]</s>`` and a line break.
Control strings inside roles and texts are escaped with backslashes and read back as they
were.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import give_back, table, text_batches
from tidelake.llm.tokens import tokenizer

OPEN, MIDDLE, CLOSE = "<s>[INST] ", "\n", "[/INST]</s>\n"
#: Strings that mean something to a template: this one's and other common ones.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
BUDGET, HISTORY, OVERHEAD = 2048, 512, 16

_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(\\?)")
_ESCAPED_ROLE = re.compile(r"\\([\\N]?)")
_TURN = re.compile(re.escape(OPEN) + r"(.*?)" + re.escape(CLOSE), re.DOTALL)
WINDOWS = "conv_id string, window long, n_turns int, n_repeated int, text string, loss array<struct<start: long, end: long>>"


def escape(text: str) -> str:
    """Doubles backslashes and puts one after the first character of each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """What escape() was given."""
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    """As escape(), on one line: a line break is a backslash and N."""
    return escape(role).replace("\n", "\\N")


def unescape_role(role: str) -> str:
    return _ESCAPED_ROLE.sub(lambda m: "\n" if m[1] == "N" else m[1], role)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as the template has it, and where its text starts and ends."""
    head, body = OPEN + escape_role(role) + MIDDLE, escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse_turns(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a window; start and end are of the escaped text."""
    out = []
    for m in _TURN.finditer(text):
        role, _, body = m[1].partition(MIDDLE)
        end = m.end() - len(CLOSE)
        out.append((unescape_role(role), unescape(body), end - len(body), end))
    return out


class Windows:
    """Cuts one conversation, turn by turn, to windows; keeps no more than a window's turns."""

    def __init__(self, budget: int = BUDGET, history: int = HISTORY) -> None:
        self.budget, self.history = budget, history
        self.system: tuple | None = None
        self.shown: list[tuple] = []
        self.repeated = self.used = self.count = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        """Takes a turn; yields the window that it did not fit, if any."""
        turn = (role, text, tokens + OVERHEAD)
        first = not self.shown
        if not first and self.used + turn[2] > self.budget and len(self.shown) > self.repeated:
            yield self.window()
            room = min(self.history, self.budget - turn[2] - (self.system[2] if self.system else 0))
            kept: list[tuple] = []
            held = 0
            for old in reversed(self.shown[1 if self.system else 0 :]):  # suffix sums of the latest turns
                held += old[2]
                if held > room:
                    break
                kept.insert(0, old)
            self.shown = ([self.system] if self.system else []) + kept
            self.repeated, self.used = len(self.shown), sum(t[2] for t in self.shown)
        if first and role == SYSTEM_ROLE:
            self.system = turn
        self.shown.append(turn)
        self.used += turn[2]

    def window(self) -> tuple:
        """(number, turns, repeated turns, text, loss spans) of the turns held."""
        parts, loss, at = [], [], 0
        for i, (role, text, _) in enumerate(self.shown):
            part, start, end = format_turn(role, text)
            if role == TARGET_ROLE and i >= self.repeated and end > start:
                loss.append({"start": at + start, "end": at + end})
            parts.append(part)
            at += len(part)
        self.count += 1
        return self.count - 1, len(self.shown), self.repeated, "".join(parts), loss


def _sorted(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_chats(turns: DataFrame, tokenizer_path: str, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Windows of all conversations: conv_id, window, n_turns, n_repeated, text, loss spans.

    Turns are in the order of turn, then role and text, nulls first.  Null roles and texts
    are empty; rows without a conversation id form one conversation of their own.  Turns
    stream through a task in order, so a long conversation takes no more memory than a
    window.  An empty table gives no windows.
    """
    rows = turns.select(F.col(conv_col).cast("string").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text_batches(turns.sparkSession)
    kind = turns.schema[conv_col].dataType

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer(tokenizer_path)
        now, at = None, object()
        columns = ["conv_id", "window", "n_turns", "n_repeated", "text", "loss"]
        for pdf in batches:
            out = []
            sizes = [len(x) // tok.kind.itemsize for x in tok.encode(list(pdf["text"]))]
            for conv, role, text, tokens in zip(pdf["conv_id"], pdf["role"], pdf["text"], sizes):
                if now is None or conv != at:
                    if now is not None:
                        out.append((at, *now.window()))
                    now, at = Windows(budget, history), conv
                out += [(conv, *w) for w in now.add(role, text, tokens)]
            yield pd.DataFrame(out, columns=columns)
        give_back()
        if now is not None:
            yield pd.DataFrame([(at, *now.window())], columns=columns)

    # ids travel as text: pandas would make integers with a null among them floats
    return _sorted(rows, "turn", "role", "text").mapInPandas(windows, WINDOWS).withColumn("conv_id", F.col("conv_id").cast(kind))


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from formatted windows alone."""
    kind = windows.schema["conv_id"].dataType
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, have = object(), False
        n = chars = total = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()
        for pdf in batches:
            out = []
            for conv, repeated, text, spans in zip(pdf["conv_id"], pdf["n_repeated"], pdf["text"], pdf["loss"]):
                if not have or conv != at:
                    if have:
                        out.append((at, n, turns.hexdigest(), chars, loss.hexdigest(), total))
                    at, have, n, chars, total, turns, loss = conv, True, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, said, _, _ in parse_turns(text)[repeated:]:
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                for span in spans:
                    target = unescape(text[span["start"] : span["end"]])
                    loss.update(target.encode("utf-8", "surrogatepass"))
                    chars += len(target)
                total += len(text)
            yield pd.DataFrame(out, columns=columns)
        if have:
            yield pd.DataFrame([(at, n, turns.hexdigest(), chars, loss.hexdigest(), total)], columns=columns)

    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    texts = windows.withColumn("conv_id", F.col("conv_id").cast("string"))
    return _sorted(texts, "window").mapInPandas(read, schema).withColumn("conv_id", F.col("conv_id").cast(kind))


def chat_digests(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Formats turns to a table in the shared folder and describes each conversation from it."""
    return read_back(table(format_chats(turns, tokenizer_path), "chat-windows"))

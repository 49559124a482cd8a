"""Chat formatting by a declarative template and a finite-state machine.

A ``Template`` says how a turn is written, which roles exist, which may follow
which, and whose text carries loss.  Each turn becomes three segments: its head
(role marker), its text, its tail; the text of a role in ``loss`` is the only
segment with the loss flag.  The machine's state is the last role; a turn that
its state does not allow, an unknown role, or an end in a state that is not final
marks the conversation with the place and kind of its first fault.  Faulty
conversations are formatted all the same: filtering is the caller's choice.

Control strings inside texts are escaped so that no text can forge a turn: in
every ``<``, any number of ``\\``, ``|`` one more ``\\`` is put before the ``|``.  This is
one-to-one, and ``unescaped`` undoes it.  A role is escaped in the same way, with
line breaks written ``\\n`` and ``\\`` doubled.

A conversation may be of any length: rows are sorted by (conversation, turn) in
each partition and streamed through the machine, so memory holds one batch and
the machine's state.  One conversation is one sequence, so its turns meet in one
task; they are never gathered in memory.

Defined results.  NULL text is empty.  NULL turns come first; rows of equal turn
are ordered by role and text, and each is a turn (repeated rows too).  NULL
conv_ids form one conversation.  A NULL role is the empty role, which no template
knows.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import named


@dataclass(frozen=True)
class Template:
    head: str = "<|im_start|>{role}\n"
    tail: str = "<|im_end|>\n"
    loss: tuple = ("assistant",)
    # state (last role; "" at the start) -> roles that may follow
    follows: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple = ("assistant",)


CHATML = Template()
BATCH = 4096
SEGMENTS = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("kind", pa.string()), ("text", pa.string()),
                      ("loss", pa.bool_()), ("fault", pa.string())])


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escaped_role(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\\" if m[1] == "\\" else "\n", unescaped(role))


def sequenced(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), a conversation's turns together and in order."""
    rows = turns.select(named("conv_id").cast("long").alias("conv_id"), named("turn").cast("long").alias("turn"),
                        F.coalesce(named("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(named("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def segments(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, segment (from 0), kind (head, text, tail; last an empty 'end'),
    text, loss, fault (on the end segment: the first fault, or NULL)."""

    def run(batches):
        out, conv, state, number, fault = [], None, None, 0, None

        def end():
            nonlocal fault
            if fault is None and state not in template.final:
                fault = f"ends after {state!r}"
            out.append((conv, number, "end", "", False, fault))

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SEGMENTS)],
                                               schema=SEGMENTS)
            out.clear()
            return batch

        for batch in batches:
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if state is None or c != conv:
                    if state is not None:
                        end()
                    conv, state, number, fault = c, "", 0, None
                if fault is None and role not in template.follows.get(state, ()):
                    fault = f"turn {number // 3}: {role!r} after {state!r}"
                state = role
                name = escaped_role(role)
                for kind, part, loss in (("head", template.head.format(role=name), False),
                                         ("text", escaped(text), role in template.loss),
                                         ("tail", template.tail, False)):
                    out.append((conv, number, kind, part, loss, None))
                    number += 1
                if len(out) >= BATCH:
                    yield flush()
        if state is not None:
            end()
        if out:
            yield flush()

    return sequenced(turns).mapInArrow(
        run, "conv_id long, segment long, kind string, text string, loss boolean, fault string")


def in_order(found: DataFrame) -> DataFrame:
    """Segments that were stored and read again, each conversation together and in order."""
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "segment")


def read_back(found: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation, from ``segments``' output alone (streamed; the
    turns are recovered from heads and texts): conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, formatted_sha256, fault.

    Segments must come as ``segments`` gives them or ``in_order`` puts them: a segment
    out of its place, or a conversation without its end, raises an error."""
    before, after = template.head.split("{role}")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
             "formatted_sha256", "fault"]

    def run(batches):
        fresh = lambda: (0, hashlib.sha256(), 0, hashlib.sha256(), 0, hashlib.sha256(), "")
        turns, all_turns, loss, all_loss, chars, whole, role = fresh()
        due = (None, 0)                      # conversation (any at its start) and segment that come next
        for batch in batches:
            rows = []
            for conv, segment, kind, text, is_loss, fault in zip(*(
                    batch.column(n).to_pylist() for n in ("conv_id", "segment", "kind", "text", "loss", "fault"))):
                if segment != due[1] or segment and conv != due[0]:
                    raise ValueError(f"segment {segment} of conversation {conv} is out of its place: use in_order")
                due = (None, 0) if kind == "end" else (conv, segment + 1)
                chars += len(text)
                whole.update(text.encode())
                if kind == "head":
                    role = unescaped_role(text[len(before):len(text) - len(after)])
                elif kind == "text":
                    plain = unescaped(text)
                    turns += 1
                    all_turns.update(f"{role}\n{plain}\n".encode())
                    if is_loss:
                        loss += len(plain)
                        all_loss.update(plain.encode())
                elif kind == "end":
                    rows.append((conv, turns, all_turns.hexdigest(), loss, all_loss.hexdigest(), chars,
                                 whole.hexdigest(), fault))
                    turns, all_turns, loss, all_loss, chars, whole, role = fresh()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if n == "fault" else None) if n != "conv_id" else pa.array(c, pa.int64())
                     for n, c in zip(names, zip(*rows))], names=names)

    return found.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long, formatted_sha256 string, fault string")


def parsed(formatted: str, template: Template = CHATML) -> list[tuple[str, str]]:
    """(role, text) of each turn in a whole formatted conversation."""
    before, after = template.head.split("{role}")
    turn = re.compile(re.escape(before) + r"(.*?)" + re.escape(after) + r"(.*?)" + re.escape(template.tail), re.S)
    return [(unescaped_role(m[1]), unescaped(m[2])) for m in turn.finditer(formatted)]

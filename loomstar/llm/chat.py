"""Chat formatting by replaying an event log.

A log row is an event: `message` begins a message with a full text, `delta` adds to it,
`edit` replaces its text, `regenerate` clears it for the deltas to come, `delete` removes
it.  The log is dealt by ranges of conversation and message and sorted by sequence; one
pass folds the events of each message and renders it.  A task holds one message at a time,
and a conversation of any length is folded and rendered by as many tasks as it fills; how
many turns each of them found puts its turns in their place.

The template marks every turn with control strings.  Control strings inside texts are
escaped by a backslash after their first character, and backslashes are doubled, so that
a reader gets every text back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, narrow, store

#: Control strings of common chat templates, none of which a text may hold.
CONTROL = [
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
]
START, END = "<|im_start|>", "<|im_end|>\n"
#: Roles whose texts bear loss.
TRAINED = frozenset({"assistant"})

_GUARDED = re.compile("|".join(["\\\\", *map(re.escape, CONTROL)]))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """`text` without any control string, reversibly."""
    return _GUARDED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def _role(role: str) -> str:
    """A role on one line: a line feed in it is escaped as well."""
    return escape(role).replace("\n", "\\n\\")


def _role_back(role: str) -> str:
    """The inverse of `_role`: doubled backslashes first, so no escape is mistaken."""
    return re.sub(r"\\(\\|n\\|)", lambda m: {"\\": "\\", "n\\": "\n", "": ""}[m[1]], role)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One formatted turn, and where its loss mask begins and how long it is (0 if untrained)."""
    head, body = f"{START}{_role(role)}\n", escape(text)
    return f"{head}{body}{END}", len(head), len(body) if role in TRAINED else 0


def read_back(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    head, _, rest = formatted.partition("\n")
    return _role_back(head.removeprefix(START)), unescape(rest.removesuffix(END))


TURN = "conv_id long, turn_no long, role string, formatted string, loss_start long, loss_length long"


_FOLDED = "part int, conv_id long, nth long, role string, formatted string, loss_start long, loss_length long"


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted events to formatted turns, numbered within this task and conversation."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    message, nth, conv = None, 0, None  # message: [its key, role, parts]

    def close(rows: list) -> None:
        nonlocal nth
        if message is not None and message[2] is not None:
            formatted, start, length = render(message[1], "".join(message[2]))
            rows.append((part, message[0][0], nth, message[1], formatted, start, length))
            nth += 1

    for batch in batches:
        rows: list[tuple] = []
        columns = (batch[c].tolist() for c in ("conv", "message", "kind", "role", "text"))
        for conv_id, at, kind, role, text in zip(*columns):
            text = text or ""
            if message is None or message[0] != (conv_id, at) or kind == "message":
                close(rows)
                if message is None or conv != conv_id:
                    conv, nth = conv_id, 0
                message = [(conv_id, at), role or "", []]
            if kind == "delete":
                message[2] = None
            elif kind in ("edit", "regenerate", "message") or message[2] is None:
                message[2] = [text]
            else:
                message[2].append(text)
        if rows:
            yield _turns(rows)
    rows = []
    close(rows)
    if rows:
        yield _turns(rows)


def _turns(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in _FOLDED.split(", ")])
    out["conv_id"] = pd.array([None if x == "" else int(x) for x in out["conv_id"]], dtype="Int64")
    return out


def format_chats(events: DataFrame) -> DataFrame:
    """Formatted turns (TURN) of all conversations of an event log.

    `events` has conv_id, message, seq, kind, role, text.  Events are applied in the order
    of conversation, message, seq, then kind, role and text, so ties and repeated rows have
    one result; each `message` event is a turn of its own.  Null numbers sort first, null
    ids are one conversation; null texts and roles are empty; an unknown or null kind adds
    to its message; a delta after a `delete` starts the message anew.  A conversation's
    formatted text is its turns' `formatted` in order of turn_no.
    """
    one = narrow(events, conv_id="long", message="long", seq="long", kind="string", role="string", text="string")
    order = ["conv_id", "message", "seq", "kind", "role", "text"]
    dealt = one.repartitionByRange("conv_id", "message").sortWithinPartitions(*order)
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (("conv_id", "conv"), ("message", "message"))]
    folded = store(bounded(dealt.select(*keys, "kind", "role", "text")).mapInPandas(_fold, _FOLDED), "turns")
    # Ranges meet inside a conversation at most once each, so few conversations lie in several parts.
    found = folded.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    split = found.groupBy(F.col("conv_id").alias("split")).agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    found = found.join(split, F.col("conv_id").eqNullSafe(F.col("split"))).withColumn("before", F.sum("n").over(before))
    found = found.select(F.col("conv_id").alias("split"), F.col("part").alias("of"), F.coalesce("before", F.lit(0)).alias("before"))
    place = F.col("conv_id").eqNullSafe(F.col("split")) & (F.col("part") == F.col("of"))
    # Two rows a part at most.
    turns = folded.join(F.broadcast(found), place, "left").withColumn("turn_no", F.col("nth") + F.coalesce("before", F.lit(0)))
    return turns.select(*(x.split()[0] for x in TURN.split(", ")))


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the digests of a conversation are made of, turn by turn, read from the formatted text."""
    for batch in batches:
        plain, loss_at, chars = [], [], []
        for formatted, start, length in zip(batch["formatted"], batch["loss_start"], batch["loss_length"]):
            role, text = read_back(formatted)
            masked = unescape(formatted[start : start + length])
            if masked not in ("", text):
                raise ValueError("a loss mask covers a text or nothing")
            plain.append(f"{role}\n{text}\n")
            loss_at.append(len(role) + 1 if masked else -1)
            chars.append(len(formatted))
        yield pd.DataFrame({
            "conv": batch["conv"], "turn_no": batch["turn_no"], "plain": plain, "loss_at": loss_at, "chars": chars,
        })


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns in order to one row per conversation."""
    names = [x.split()[0] for x in DIGEST.split(", ")]
    now, state = None, None  # state: turns, their digest, loss characters, their digest, characters

    def row() -> tuple:
        conv = None if now == "" else int(now)
        return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        out["conv_id"] = out["conv_id"].astype("Int64")
        return out

    for batch in batches:
        rows = []
        for conv, plain, loss_at, chars in zip(*(batch[c].tolist() for c in ("conv", "plain", "loss_at", "chars"))):
            if state is None or conv != now:
                if state is not None:
                    rows.append(row())
                now, state = conv, [0, sha256(), 0, sha256(), 0]
            state[0] += 1
            state[1].update(plain.encode("utf-8", "surrogatepass"))
            if loss_at >= 0:
                loss = plain[loss_at:-1]
                state[2] += len(loss)
                state[3].update(loss.encode("utf-8", "surrogatepass"))
            state[4] += chars
        if rows:
            yield frame(rows)
    if state is not None:
        yield frame([row()])


def digest_chats(turns: DataFrame) -> DataFrame:
    """One row (DIGEST) per conversation of TURN rows in any order, read back from the formatted text.

    Turns are read where they are.  Only the digests, which take a conversation's turns one
    after another, are one task's work for each conversation.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    rows = bounded(turns.select(conv, "turn_no", "formatted", "loss_start", "loss_length"))
    read = rows.mapInPandas(_read, "conv string, turn_no long, plain string, loss_at long, chars long")
    dealt = read.repartition("conv").sortWithinPartitions("conv", "turn_no")
    return bounded(dealt.select("conv", "plain", "loss_at", "chars")).mapInPandas(_digest, DIGEST)


#: Characters of a streamed delta; a text has DELTAS at most, longer ones then.
DELTA, DELTAS = 400, 1_000


def as_events(conversations: DataFrame) -> DataFrame:
    """The log that rows of (conv_id, turn, role, text) come from, by a rule on conv_id and turn.

    A quarter each of the turns is one `message`; a message without text and its deltas; a
    draft and its edit; a draft with a delta, a regeneration and the deltas of the final
    text.  Rows of one turn follow each other in the order of the table.
    """
    one = narrow(conversations, conv_id="long", turn="long", role="string", text="string")
    # 20 bits of the task, 30 of the row in it, 12 of the event: no two rows' events mix.
    row = F.monotonically_increasing_id()
    place = F.shiftleft(F.shiftright(row, 33), 42) + F.shiftleft(row.bitwiseAND(F.lit((1 << 30) - 1)), 12)
    text, length = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    step = F.greatest(F.lit(DELTA), F.ceil(length / DELTAS).cast("int"))
    events = lambda *pairs: F.array(*(F.struct(F.lit(k).alias("kind"), t.alias("text")) for k, t in pairs))
    cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(length / step).cast("int") - 1))
    deltas = F.transform(cuts, lambda k: F.struct(F.lit("delta").alias("kind"), F.substring(text, k * step + 1, step).alias("text")))
    draft = F.concat(F.reverse(text), F.lit(" draft"))
    empty = F.lit("")
    way = F.pmod(F.coalesce("conv_id", F.lit(0)) + F.coalesce("turn", F.lit(0)), F.lit(4))
    log = (
        F.when(way == 0, events(("message", text)))
        .when(way == 1, F.concat(events(("message", empty)), deltas))
        .when(way == 2, events(("message", draft), ("edit", text)))
        .otherwise(F.concat(events(("message", draft), ("delta", draft), ("regenerate", empty)), deltas))
    )
    each = one.select("conv_id", "turn", "role", place.alias("place"), F.posexplode(log).alias("nth", "event"))
    return each.select(
        "conv_id", F.col("turn").alias("message"), (F.col("place") + F.col("nth")).alias("seq"), "event.kind", "role", "event.text"
    )

"""Chat formatting by schema fingerprints.

Records come in several layouts (prompt and response, instruction with input and
output, lists of messages) as columns of one table, unused columns NULL.  A
record's fingerprint is a hash of the sorted nested paths of its non-NULL fields;
it selects a declarative mapping, a list of roles and the paths of their texts,
that turns the record into canonical turns ``array<struct<role, text>>``.  The
turns are rendered by one template::

    <|im_start|>{role}\\n{text}<|im_end|>\\n

Control strings cannot appear inside texts: a backslash is put between ``<`` and
``|`` (one more where backslashes already stand there), which is undone by taking
one away.  Roles are percent-encoded for ``%``, newline and ``|``.  The loss mask
names, for each assistant turn, the piece of the output (one per turn) and the
span of the text in it, in code points.

Everything is column expressions.  Turns of a conversation meet in one row, as
its text is one string.

Defined cases: a NULL text is empty; a NULL role is the empty role; rows of one
turn number are ordered by role and text; a NULL turn number comes first; rows of
a NULL ``conv_id`` form one conversation; a fingerprint without a mapping gives
NULL turns and an empty output (``layout`` is NULL); empty tables give only what
is added to them.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """A mapping: the fields a record must hold, and where its turns come from."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()  # (role, path of the text)
    messages: str = ""  # path of a list of messages
    role: str = "role"
    text: str = "text"


#: Layouts that ``to_turns`` knows from the start.
LAYOUTS = (
    Layout("prompt", ("prompt", "response"), (("user", "prompt"), (ASSISTANT, "response"))),
    Layout("instruction", ("instruction", "input", "output"), (("system", "instruction"), ("user", "input"), (ASSISTANT, "output"))),
    Layout("bare_instruction", ("instruction", "output"), (("user", "instruction"), (ASSISTANT, "output"))),
    Layout("messages", ("messages[].role", "messages[].text"), messages="messages"),
    Layout("sharegpt", ("conversations[].from", "conversations[].value"), messages="conversations", role="from", text="value"),
)


def leaf_paths(kind, at: str = "") -> list[tuple[str, str]]:
    """``(path, top-level column or struct path that holds it)`` of every leaf of a schema;
    a list's members share ``name[]``."""
    found = []
    for f in kind.fields:
        path = f"{at}{f.name}"
        inner = f.dataType
        if inner.typeName() == "struct":
            found += leaf_paths(inner, f"{path}.")
        elif inner.typeName() == "array" and inner.elementType.typeName() == "struct":
            found += [(f"{path}[].{x.name}", path) for x in inner.elementType.fields]
        else:
            found.append((path, path))
    return found


def fingerprint_of(paths: tuple[str, ...]) -> Column:
    """The fingerprint of a record that holds exactly these paths."""
    return F.xxhash64(F.lit("\n".join(sorted(paths))))


def fingerprint(df: DataFrame, ignore: tuple[str, ...] = ()) -> Column:
    """Fingerprint of each row of ``df``: its non-NULL paths, hashed."""
    leaves = sorted(p for p in leaf_paths(df.schema) if p[1].split(".")[0] not in ignore)
    present = F.array(*[F.when(F.col(_quoted(holder)).isNotNull(), F.lit(path)) for path, holder in leaves])
    return F.xxhash64(F.array_join(present, "\n"))


def _quoted(path: str) -> str:
    return ".".join(f"`{p}`" for p in path.split("."))


def to_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS, keep: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """The columns ``keep`` with ``layout`` and ``turns``, whatever each record's layout.
    Only layouts whose fields the table has can match."""
    columns = {path for path, _ in leaf_paths(records.schema)}
    usable = [x for x in layouts if set(x.paths) <= columns]
    marked = records.withColumn("_fingerprint", fingerprint(records, keep))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for x in reversed(usable):
        if x.messages:
            made = _messages(x)
        else:
            made = F.array(*[F.struct(_role(F.lit(r)), _text(F.col(_quoted(p)))) for r, p in x.turns])
        hit = F.col("_fingerprint") == fingerprint_of(x.paths)
        name, turns = F.when(hit, F.lit(x.name)).otherwise(name), F.when(hit, made).otherwise(turns)
    return marked.select(*keep, name.alias("layout"), turns.alias("turns"))


def _messages(layout: Layout) -> Column:
    return F.transform(_quoted(layout.messages), lambda m: F.struct(_role(m[layout.role]), _text(m[layout.text])))


def _role(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")).alias("role")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")).alias("text")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("|"), F.lit("%7C"))


def unescape_role(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("%7C"), F.lit("|")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(chats: DataFrame) -> DataFrame:
    """Replace ``turns`` by ``formatted`` and ``loss_mask``, a list of ``piece, first, length``."""
    safe = F.transform("turns", lambda t: F.struct(escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text"), (t["role"] == ASSISTANT).alias("loss")))
    rendered = chats.withColumn("turns", safe)
    pieces = F.transform("turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n")))
    spans = F.transform(
        "turns",
        lambda t, i: F.struct(
            i.cast("int").alias("piece"), (F.lit(len(START) + 2) + F.length(t["role"])).alias("first"), F.length(t["text"]).alias("length"), t["loss"].alias("loss")
        ),
    )
    mask = F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["piece"], s["first"], s["length"]))
    kept = [c for c in chats.columns if c != "turns"]
    return rendered.select(*kept, F.coalesce(F.array_join(pieces, ""), F.lit("")).alias("formatted"), mask.alias("loss_mask"))


def pieces_of(formatted: Column) -> Column:
    """The output cut after each turn; the end marker is left off."""
    cut = F.split(formatted, r"<\|im_end\|>\n")
    return F.slice(cut, 1, F.size(cut) - 1)


def read_back(formatted: DataFrame) -> DataFrame:
    """Replace ``formatted`` and ``loss_mask`` by what they hold: ``turns`` and ``loss_texts``."""
    kept = [c for c in formatted.columns if c not in ("formatted", "loss_mask")]
    cut = formatted.select("*", pieces_of(F.col("formatted")).alias("_pieces"))

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substring(piece, len(START) + 1, 2**31 - 1), "\n", 1)
        text = F.substr(piece, F.lit(len(START) + 2) + F.length(role))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    # the mask as one entry per piece (NULL: not trained on), so that each piece is cut once
    spans = F.map_from_entries(F.transform("loss_mask", lambda s: F.struct(s["piece"], F.struct(s["first"].alias("first"), s["length"].alias("length")))))
    return (
        cut.withColumn("_spans", spans)
        .select(
            *kept,
            F.char_length("formatted").cast("long").alias("formatted_chars"),
            F.transform("_pieces", turn).alias("turns"),
            F.filter(
                F.transform(
                    "_pieces",
                    lambda p, i: F.when(F.map_contains_key("_spans", i), unescape(F.substr(p, F.element_at(F.col("_spans"), i)["first"], F.element_at(F.col("_spans"), i)["length"]))),
                ),
                lambda t: t.isNotNull(),
            ).alias("loss_texts"),
        )
    )


def records_of(rows: DataFrame) -> DataFrame:
    """One record per conversation from rows of ``conv_id, turn, role, text``.

    Two-turn and three-turn exchanges land as prompt/response and instruction
    records, all others as lists of messages: the layouts a mixed corpus comes in.
    """
    slim = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), _role(F.col("role")), _text(F.col("text")))
    chats = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    roles = F.array_join(F.transform("t", lambda t: t["role"]), "\n")
    pair, triple = roles == "user\nassistant", roles == "system\nuser\nassistant"
    pair, triple = pair & (F.size("t") == 2), triple & (F.size("t") == 3)
    return chats.select(
        "conv_id",
        F.when(pair, F.get("t", F.lit(0))["text"]).alias("prompt"),
        F.when(pair, F.get("t", F.lit(1))["text"]).alias("response"),
        F.when(triple, F.get("t", F.lit(0))["text"]).alias("instruction"),
        F.when(triple, F.get("t", F.lit(1))["text"]).alias("input"),
        F.when(triple, F.get("t", F.lit(2))["text"]).alias("output"),
        F.when(~(pair | triple), F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))).alias("messages"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What ``formatted`` says when read back, as counts and SHA-256 digests."""
    back = read_back(formatted)
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )

r"""Chat formatting by a grammar round trip (operator 13), with DataFrame functions only.

A conversation is the text of its turns, one after another:

    turn  = header LF content LF "</turn>" LF
    header = "### System:" | "### User:" | "### Assistant:" | "### @" role ":"

Control strings are ``### System:``, ``### User:``, ``### Assistant:``, ``### @`` and
``</turn>``.  One marks structure exactly if no backslash stands before it.  A turn is first
rendered as it is and parsed again; if what the parser recovers is not the turn, its content
is escaped: a backslash is put before each control string, however many stand there already,
and the parser takes one away.  That form always comes back (controls hold neither a backslash
nor a line feed and never overlap, so no new one can arise), hence two forms suffice.  The
whole conversation is parsed once more and compared with its source; a difference would raise.

``format_conversations`` gives, for each conversation, the text and one span for each turn:
where the turn and its content begin and end, in code points, and whether it is under the loss
mask.  ``read_back`` recovers turns and the text under the mask from these alone.

A conversation's text is one value, so one row holds all of its turns, as the format asks;
turns are shuffled once, and positions come from a running sum over the same partitioning.

Defined cases: turns go by (turn, role, text), null turns first, repeated rows are all kept;
a null text or role is empty; an unknown role is written after ``@`` with percent
codes; rows with a null ``conv_id`` are one conversation; an empty table gives no
rows; only the four columns are read, so others never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The known roles and their headers, the end of a turn.
HEADERS = {"system": "### System:", "user": "### User:", "assistant": "### Assistant:"}
OTHER, END = "### @", "</turn>"
#: Codes in the names of other roles, so that none holds a control string; the percent sign first.
CODES = {"%": "%25", ":": "%3A", "\n": "%0A", "#": "%23", "<": "%3C"}
CONTROLS = "|".join([*HEADERS.values(), OTHER, END])
BEGIN = "|".join([*HEADERS.values(), OTHER])


def escaped(text: Column) -> Column:
    """A backslash before each control string."""
    return F.regexp_replace(text, f"({CONTROLS})", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({CONTROLS})", "$1")


def header(role: Column) -> Column:
    coded = role
    for plain, code in CODES.items():
        coded = F.replace(coded, F.lit(plain), F.lit(code))
    out = F.concat(F.lit(OTHER), coded, F.lit(":"))
    for name, mark in HEADERS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def role_of(head: Column) -> Column:
    coded = F.substr(head, F.lit(len(OTHER) + 1), F.char_length(head) - len(OTHER) - 1)
    out = coded
    for plain, code in reversed(CODES.items()):
        out = F.replace(out, F.lit(code), F.lit(plain))
    for name, mark in HEADERS.items():
        out = F.when(head == mark, F.lit(name)).otherwise(out)
    return out


def rendered(role: Column, content: Column) -> Column:
    return F.concat(header(role), F.lit("\n"), content, F.lit(f"\n{END}\n"))


def pieces_of(formatted: Column) -> Column:
    """The text cut before each header that no backslash escapes."""
    return F.split(formatted, rf"(?<!\\)(?={BEGIN})")


def parsed_turn(piece: Column) -> Column:
    """struct(role, text) of one piece; null if it is not exactly one turn."""
    parts = F.split(piece, rf"(?<!\\){END}")
    head, rest = F.substring_index(piece, "\n", 1), parts[0]
    content = F.substr(rest, F.char_length(head) + 2, F.char_length(rest) - F.char_length(head) - 2)
    whole = (F.size(parts) == 2) & (parts[1] == "\n") & F.endswith(rest, F.lit("\n")) & F.rlike(head, F.lit(f"^({BEGIN})")) & \
        F.endswith(head, F.lit(":")) & (F.char_length(rest) >= F.char_length(head) + 2)
    return F.when(whole, F.struct(role_of(head).alias("role"), unescaped(content).alias("text")))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    return F.transform(pieces_of(formatted), parsed_turn)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, spans): a span is struct(role, from, start, end, to, loss); ``from``
    and ``to`` bound the turn, ``start`` and ``end`` its content, in code points from 0."""
    turns = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Grammar round trip of each turn by itself: the first form that comes back.
    source = F.array(F.struct("role", "text"))
    plain = rendered(F.col("role"), F.col("text"))
    back = F.coalesce(parsed(plain) == source, F.lit(False))
    turns = turns.withColumn("content", F.when(back, F.col("text")).otherwise(escaped(F.col("text"))))
    turns = turns.withColumn("piece", rendered(F.col("role"), F.col("content")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = (turns.withColumn("at", F.row_number().over(order))
             .withColumn("to", F.sum(F.char_length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))))
    start = F.col("to") - F.char_length("piece") + F.char_length(header(F.col("role"))) + 1
    span = F.struct("role", (F.col("to") - F.char_length("piece")).alias("from"), start.alias("start"),
                    (start + F.char_length("content")).alias("end"), "to", (F.col("role") == "assistant").alias("loss"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "piece", "text", span.alias("span")))).alias("t"))
    out = whole.select("conv_id", F.array_join("t.piece", "").alias("formatted"), F.col("t.span").alias("spans"),
                       F.transform("t", lambda t: F.struct(t["span"]["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    same = F.coalesce(parsed(F.col("formatted")) == F.col("source"), F.lit(False))
    return out.select("conv_id", F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.lit("a formatted conversation does not parse back to its turns"))).alias("formatted"), "spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns array<struct<role, text>>, loss array<string>) read from the
    formatted text and its spans: turns by the grammar, texts under the mask by the spans."""
    cut = F.arrays_zip(pieces_of(F.col("formatted")).alias("piece"), F.col("spans").alias("span"))

    def under(z: Column) -> Column:
        s = z["span"]
        return unescaped(F.substr(z["piece"], (s["start"] - s["from"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))

    return formatted.select("conv_id", "formatted", parsed(F.col("formatted")).alias("turns"),
                            F.transform(F.filter(cut, lambda z: z["span"]["loss"]), under).alias("loss"))


def chat_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back."""
    read = read_back(format_conversations(conversations))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))

"""Chat formatting with Spark expressions: turns to one marked text, a loss mask, and back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template. A control string starts with "<|"; escaped text never does.
START, END, JOIN = "<|im_start|>", "<|im_end|>", "<|im_join|>"


def escape(text: Column) -> Column:
    """Backslashes are doubled and ``<|`` becomes ``<\\|``: an odd run of backslashes, which the
    first step leaves nowhere. So no control string is left, and :func:`unescape` is exact."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As :func:`escape`; a line break, which ends the role in the template, becomes ``<\\n|``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n|"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n|"), F.lit("\n")))


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row a conversation: its id, ``formatted``, and ``loss_spans`` (start, length).

    A run of turns of one role is one block, ``<|im_start|>role\\ntexts<|im_end|>\\n``, its texts
    joined by ``<|im_join|>``, so that reading back still finds each turn. A span covers one text of
    the role ``learn`` as it stands in ``formatted``, without marks; in code points, from 0.

    Turns are sorted by turn, then role and text, NULL first: ties and repeated rows have one
    place each and are all kept. A NULL role or text is empty. Rows without a conversation id are
    one conversation, with a NULL id. Other columns are not read. An empty table gives no row.
    A conversation is one text and so one group; what bounds it is the longest text Spark holds.
    """
    collected = turns.select(
        F.col(f"`{conversation}`").alias("conv"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    ).groupBy("conv").agg(F.array_sort(F.collect_list("said")).alias("turns"))

    # A block starts where the role changes, and ends where the next one starts.
    last = F.size("turns") - 1
    starts = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | (F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"] != F.col("turns")[i]["role"]),
    )
    blocks = F.transform(
        F.col("starts"),
        lambda start, i: F.struct(
            F.col("turns")[start]["role"].alias("role"),
            F.transform(
                F.slice(
                    "turns",
                    start + 1,
                    F.coalesce(F.get(F.col("starts"), i + 1), F.size("turns")) - start,
                ),
                lambda said: escape(said["text"]),
            ).alias("texts"),
        ),
    )
    head = lambda b: F.concat(F.lit(START), escape_role(b["role"]), F.lit("\n"))
    body = lambda b: F.concat(head(b), F.array_join(b["texts"], JOIN), F.lit(END + "\n"))
    # Where each text starts: the lengths before it, summed up along all texts.
    steps = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda text, i: F.struct(
                    (b["role"] == F.lit(learn)).alias("learn"),
                    F.when(i == 0, F.length(head(b))).otherwise(F.lit(len(JOIN))).alias("gap"),
                    F.length(text).alias("length"),
                    F.when(i == F.size(b["texts"]) - 1, F.lit(len(END) + 1)).otherwise(0).alias("after"),
                ),
            ),
        )
    )
    return (
        collected.withColumn("starts", starts)
        .withColumn("blocks", blocks)
        .withColumn("formatted", F.array_join(F.transform("blocks", body), ""))
        .withColumn("steps", steps)
        .select(F.col("conv").alias(conversation), "formatted", _spans(F.col("steps")).alias("loss_spans"))
    )


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often lambdas in it use the value."""
    return F.transform(F.array(value), body)[0]


def _width(size: Column) -> Column:
    return F.greatest(F.ceil(F.sqrt(size)), F.lit(1)).cast("int")


def _part(at: Column, width: Column) -> Column:
    return F.floor(at / width).cast("int")


def _before(sizes: Column) -> Column:
    """The sums of the sizes before each: those of whole parts of about the square root of their number are
    added up first, so that nothing grows with the square of it."""
    def summed(some: Column) -> Column:
        return F.aggregate(some, F.lit(0), lambda a, b: a + b)

    def starts(width: Column) -> Column:
        sums = F.transform(
            F.sequence(F.lit(0), _part(F.size(sizes) - 1, width)),
            lambda part: summed(F.slice(sizes, part * width + 1, width)),
        )
        of_parts = _bound(sums, lambda s: F.transform(s, lambda _, part: summed(F.slice(s, F.lit(1), part))))
        return _bound(of_parts, lambda before: F.transform(
            sizes, lambda _, i: before[_part(i, width)] + summed(F.slice(sizes, i - i % width + 1, i % width))
        ))

    return _bound(_width(F.size(sizes)), starts)


def _spans(steps: Column) -> Column:
    def spans(steps: Column) -> Column:
        sizes = F.transform(steps, lambda s: s["gap"] + s["length"] + s["after"])
        placed = _bound(_bound(sizes, _before), lambda before: F.transform(
            steps,
            lambda s, i: F.struct(s["learn"], (before[i] + s["gap"]).alias("start"), s["length"]),
        ))
        return F.transform(
            F.filter(placed, lambda p: p["learn"]),
            lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")),
        )

    return _bound(steps, spans)


def read_turns(formatted: Column) -> Column:
    """The turns in a formatted text: an array of (role, text), as they were before formatting."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b: b != "")

    def turns(block):
        role = F.substring_index(block, "\n", 1)
        body = F.substring_index(F.substring(block, F.length(role) + 2, F.length(block)), END, 1)
        return F.transform(
            F.split(body, r"<\|im_join\|>"),
            lambda text: F.struct(unescape_role(role).alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def masked(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, with nothing between.

    The text is cut into parts first, about the square root of the number of spans, so that no span is
    looked for from the start of the whole text.
    """
    def under(text: Column, width: Column) -> Column:
        parts = F.transform(
            F.sequence(F.lit(0), _part(F.length(text), width)), lambda n: F.substring(text, n * width + 1, width)
        )
        return _bound(parts, lambda parts: F.transform(spans, lambda s: unescape(F.substring(
            F.array_join(
                F.slice(parts, _part(s["start"], width) + 1,
                        _part(s["start"] + s["length"], width) - _part(s["start"], width) + 1), "",
            ),
            s["start"] % width + 1, s["length"],
        ))))

    texts = _bound(formatted, lambda text: _bound(
        F.greatest(F.ceil(F.length(text) / _width(F.size(spans))), F.lit(1)).cast("int"), lambda width: under(text, width)
    ))
    return F.array_join(texts, "")

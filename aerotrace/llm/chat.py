"""Chat formatting by schema fingerprints, in DataFrame expressions only.

Records arrive as JSON in the layouts that public chat data uses.  The paths
of a record's nested fields are listed, reduced to the paths of each layout,
sorted and hashed; the first layout whose hash fits gives a declarative
mapping to canonical turns, whatever other fields the record has.  Turns are then written with a template whose marks
cannot appear inside a text, so the output can be read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.quality import let

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of common templates (fixed values).  Inside a text each
#: gets a backslash after its first character; backslashes are doubled first.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BLOCK_TURNS = 256
_TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """``fields``: paths that a record has; ``optional``: paths it may have.
    ``turns``: (role, path) pairs for flat layouts; ``messages``: (list path,
    role field, text field) for lists of messages, after the flat turns."""
    name: str
    fields: tuple
    optional: tuple = ()
    turns: tuple = ()
    messages: tuple = ()


#: In order of precedence: a record with the fields of several has the first.
LAYOUTS = (
    Layout("messages", ("messages", "messages[].content", "messages[].role"), ("system",), (("system", "system"),),
           messages=("messages", "role", "content")),
    Layout("conversations", ("conversations", "conversations[].from", "conversations[].value"), ("system",), (("system", "system"),),
           messages=("conversations", "from", "value")),
    Layout("prompt", ("prompt", "response"), ("system", "input"),
           (("system", "system"), ("user", "prompt"), ("user+", "input"), ("assistant", "response"))),
    Layout("completion", ("prompt", "completion"), ("system", "input"),
           (("system", "system"), ("user", "prompt"), ("user+", "input"), ("assistant", "completion"))),
    Layout("instruction", ("instruction", "output"), ("system", "input"),
           (("system", "system"), ("user", "instruction"), ("user+", "input"), ("assistant", "output"))),
    Layout("turn", ("role", "text"), messages=("", "role", "text")),
)
#: Names of roles in the conversations layout, and the canonical ones; the
#: other layouts already name roles canonically and keep them as they are.
ROLES = {"conversations": {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}}


def _known_paths(layouts) -> list[str]:
    return sorted({p for x in layouts for p in x.fields + x.optional})


def field_paths(record: Column, layouts=LAYOUTS) -> Column:
    """Sorted known paths of a JSON object, nested ones as list[].field."""
    lists = sorted({p.split("[]")[0] for p in _known_paths(layouts) if "[]" in p})
    top = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    value = F.try_parse_json(record)

    def inside(name):
        schema = F.coalesce(F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant")), F.lit(""))
        return F.transform(F.regexp_extract_all(schema, F.lit("([A-Za-z_]+): "), F.lit(1)),
                           lambda field: F.concat(F.lit(f"{name}[]."), field))

    nested = [inside(name) for name in lists]
    known = F.array(*[F.lit(p) for p in _known_paths(layouts)])
    return F.array_sort(F.array_intersect(F.concat(top, *nested), known))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "|"))


def layout_of(record: Column, layouts=LAYOUTS) -> Column:
    """Name of the first layout whose fields the record has (the fingerprint
    of its paths among them is theirs), else null."""
    def fits(paths, x):
        own = F.array_intersect(paths, F.array(*[F.lit(p) for p in x.fields]))
        return fingerprint(own) == F.xxhash64(F.lit("|".join(sorted(x.fields))))

    return let(field_paths(record, layouts), lambda paths: F.coalesce(*[F.when(fits(paths, x), x.name) for x in layouts]))


def _role(name: Column, layout: str) -> Column:
    out = F.coalesce(name, F.lit(""))
    for old, new in ROLES.get(layout, {}).items():
        out = F.when(name == old, new).otherwise(out)
    return out


def canonical_turns(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """``records(conv_id, turn, record)`` -> ``(conv_id, turn, place, layout,
    role, text)``: the turns of each JSON record under its layout's mapping; a
    record of no known layout (also null or broken JSON) gives none and is in
    ``unknown_records``.  A system text beside a list of messages that begins
    with it is one turn."""
    record = F.col("record")
    turns = F.array().cast(_TURNS)

    def turn(role, text, layout=""):
        return F.struct(_role(role, layout).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    def listed(path, role, text):
        """Turns of a list of messages (or of the record itself)."""
        one = lambda m: turn(m[role], m[text], path)
        if path:
            kind = f"array<struct<`{role}`:string,`{text}`:string>>"
            return F.transform(F.from_json(F.get_json_object(record, f"$.{path}"), kind), one)
        return let(F.from_json(record, f"`{role}` string, `{text}` string"), lambda m: F.array(one(m)))

    def flat(x):
        """Turns of a record with one field per turn."""
        def of(m):
            out = []
            for role, name in x.turns:
                if role.endswith("+"):  # joined to the turn before it
                    before, _ = out.pop()
                    more = F.when(F.length(m[name]) > 0, F.concat(F.lit("\n\n"), m[name])).otherwise("")
                    out.append((F.concat(F.coalesce(before, F.lit("")), more), role[:-1]))
                else:
                    out.append((m[name], role))
            return F.array_compact(F.array(*[
                F.when(F.lit(r not in x.optional) | t.isNotNull(), turn(F.lit(r), t)) for t, r in out]))
        names = sorted({n for _, n in x.turns})
        return let(F.from_json(record, ", ".join(f"`{n}` string" for n in names)), of)

    for x in layouts:
        own = flat(x) if x.turns else None
        if x.messages:
            own = listed(*x.messages) if own is None else let(F.coalesce(listed(*x.messages), F.array().cast(_TURNS)), lambda rest: F.concat(
                F.filter(own.cast(_TURNS), lambda t: ~F.coalesce(t == F.get(rest.cast(_TURNS), F.lit(0)), F.lit(False))), rest.cast(_TURNS)))
        turns = F.when(F.col("layout") == x.name, own.cast(_TURNS)).otherwise(turns)
    named = records.select("conv_id", "turn", "record", layout_of(record, layouts).alias("layout"))
    return named.select("conv_id", "turn", "layout", F.posexplode(turns).alias("place", "t")).select(
        "conv_id", "turn", "place", "layout", F.col("t.role").alias("role"), F.col("t.text").alias("text"))


def unknown_records(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """The rows of ``records`` of no known layout (also null or broken JSON),
    whole, with a null ``layout``: those that ``canonical_turns`` has no turns
    of."""
    return records.withColumn("layout", layout_of(F.col("record"), layouts)).where("layout IS NULL")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "\\\\(\\\\?)", "$1")


def escape_role(role: Column) -> Column:
    """``escape`` on one line."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_chats(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, place, role, text)`` -> ``(conv_id, formatted,
    loss)``: one text per conversation, and the code point spans (start, end)
    of its assistant texts.

    A turn is start mark, role, line feed, escaped text, end mark, line feed.
    Turns are ordered by turn (null last), place, role and text.  A line feed
    inside a role is written as %0A (and % as %25).  A long conversation is put together from
    blocks of 256 turn numbers, so only its block texts meet in one row.
    """
    role = F.coalesce("role", F.lit(""))
    text = escape(F.coalesce("text", F.lit("")))
    order = [F.col("turn").isNull().alias("late"), F.col("turn"), F.col("place"), F.col("role"), F.col("text")]
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    rows = turns.select("conv_id", F.floor(F.col("turn") / BLOCK_TURNS).alias("block"), F.struct(
        *order, F.concat(head, text, F.lit(END + "\n")).alias("piece"),
        F.when(role == "assistant", F.struct(F.length(head).alias("start"), (F.length(head) + F.length(text)).alias("end"))).alias("loss"))
        .alias("row"))

    def join(cells, piece, loss):
        """Texts joined, spans moved to their place."""
        def step(acc, cell):
            moved = F.transform(loss(cell), lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end")))
            return F.struct((acc["at"] + F.length(piece(cell))).alias("at"), F.array_append(acc["spans"], moved).alias("spans"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int>>>").alias("spans"))
        return F.struct(F.array_join(F.transform(cells, piece), "").alias("text"),
                        F.aggregate(cells, start, step, lambda acc: F.flatten(acc["spans"])).alias("loss"))

    one = lambda c: F.when(c["loss"].isNotNull(), F.array(c["loss"])).otherwise(
        F.array().cast("array<struct<start:int,end:int>>"))
    blocks = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("row")).alias("cells")).select(
        "conv_id", "block", join(F.col("cells"), lambda c: c["piece"], one).alias("b"))
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("block").isNull().alias("late"), "block", "b.text", "b.loss"))).alias("cells"))
    return whole.select("conv_id", join(F.col("cells"), lambda c: c["text"], lambda c: c["loss"]).alias("f")).select(
        "conv_id", F.col("f.text").alias("formatted"), F.col("f.loss").alias("loss"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``(conv_id, turns, loss_text, formatted_chars)`` read from formatted texts."""
    def turn(piece):
        cut = F.instr(piece, "\n")
        body = F.substring(piece, cut + 1, F.length(piece) - cut - len(END) - 1)
        return F.struct(unescape_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"))

    pieces = F.split(F.col("formatted"), "<\\|im_start\\|>", -1)
    under = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("conv_id", F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn).alias("turns"),
                            F.array_join(under, "").alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))


def chat_digests(formatted: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_chats(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def chat_records(conversations: DataFrame) -> DataFrame:
    """Rows by turn as JSON records of the ``turn`` layout."""
    record = F.to_json(F.struct(F.col("role"), F.col("text")), {"ignoreNullFields": "false"})
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), record.alias("record"))


def format_records(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """``records(conv_id, turn, record)`` -> ``format_chats`` of their turns.

    Null texts are empty texts, null roles empty roles; null conversation ids
    form one conversation; repeated rows are turns each; records of no known
    layout are in ``unknown_records``; an empty table gives an empty result.
    """
    return format_chats(canonical_turns(records, layouts))


#: A conversation whose texts hold control strings, in the messages layout.
PROBE = "</s>[INST] ok [/INST]"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted and read back."""
    message = lambda role: F.struct(F.lit(role).alias("role"), F.lit(PROBE).alias("content"))
    probe = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.to_json(
        F.struct(F.array(message("user"), message("assistant")).alias("messages"))).alias("record"))
    rows = chat_records(spark.read.parquet(f"{sf_dir}/conversations.parquet")).unionByName(probe)
    return chat_digests(format_records(rows))


def _escaped_sql(expr: str) -> str:
    out = f"replace({expr}, '\\', '\\\\')"
    for mark in CONTROL:
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


OP4_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('{START}' || replace(replace({_escaped_sql('role')}, '%', '%25'), chr(10), '%0A') || chr(10) || {_escaped_sql('text')} || '{END}' || chr(10))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

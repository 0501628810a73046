"""Chat, prompt assembly and SFT keys (conversations, documents, benchmark)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.constants import (
    ASSISTANT_SYSTEM_PROMPT,
    CRITIC_SYSTEM_PROMPT,
    CRITIQUE_TEMPLATE,
    IMAGE_ENHANCE_PROMPT,
    IMAGE_SYSTEM_PROMPT,
    KEY_COLOUR_QUESTION,
    LAYOUT_SYSTEM_PROMPT,
    PLAN_TAGS,
    PLANNER_SYSTEM_PROMPT,
    REFINE_LEAD,
    REFINE_SYSTEM_PROMPT,
)
from atelier.functions import chat as CH
from atelier.functions import text as T
from atelier.operators import retrieve as RT
from atelier.operators import sft as S
from atelier.operators.agg import first_by, ordered_concat
from atelier.plans import contract as C
from atelier.scenarios import scenario, sql_literal
from atelier.session import table

_GEN = "'<|im_start|>assistant' || chr(10)"


def _msg_sql(role: str, content: str) -> str:
    return f"'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


# ---------------------------------------------------------------- manifests


@scenario(
    "layer_manifest",
    """
SELECT conv_id, '[' || string_agg('{"layer_id": ' || CAST(turn AS VARCHAR) || ', "url": "generated_images/layer'
  || CAST(turn AS VARCHAR) || '.png"}', ', ' ORDER BY turn) || ']' AS manifest
FROM conversations GROUP BY conv_id
""",
)
def layer_manifest(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.col("turn").alias("layer_id"))
    return RT.layer_manifest(c, "conv_id", "turn", "layer_id")


_ODD_URL = "'assets/' || role || '/\"' || CAST(conv_id AS VARCHAR) || '\"/é' || CAST(turn AS VARCHAR) || '.png'"


@scenario(
    "format_manifest_json",
    f"""
SELECT conv_id, '[' || string_agg('{{"layer_id": ' || CAST(turn AS VARCHAR) || ', "url": "' || replace({_ODD_URL}, '"', '\\"') || '"}}', ', ' ORDER BY turn) || ']' AS manifest
FROM conversations GROUP BY conv_id
""",
)
def format_manifest_json(spark, d):
    c = table(spark, d, "conversations")
    layers = c.select("conv_id", "turn", F.col("turn").alias("layer_id"), F.expr(_ODD_URL.replace("VARCHAR", "STRING")).alias("url"))
    return RT.layer_manifest(layers, "conv_id", "turn", "layer_id", url="url")


@scenario(
    "assemble_layout_prompt",
    """
WITH f AS (
  SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS u, arg_min(text, turn) FILTER (WHERE role = 'assistant') AS a,
    '[' || string_agg('{"layer_id": ' || CAST(turn AS VARCHAR) || ', "url": "generated_images/layer' || CAST(turn AS VARCHAR) || '.png"}', ', ' ORDER BY turn) || ']' AS m
  FROM conversations GROUP BY conv_id)
SELECT conv_id, '<user_input>' || chr(10) || u || chr(10) || '</user_input>' || chr(10) || a || chr(10)
  || '<image_generator_result>' || chr(10) || m || chr(10) || '</image_generator_result>' AS layout_prompt
FROM f WHERE u IS NOT NULL AND a IS NOT NULL
""",
)
def assemble_layout_prompt(spark, d):
    c = table(spark, d, "conversations")
    user = first_by(c.filter("role = 'user'").select("conv_id", "turn", "text"), "conv_id", "turn").select("conv_id", F.col("text").alias("u"))
    asst = first_by(c.filter("role = 'assistant'").select("conv_id", "turn", "text"), "conv_id", "turn").select(
        "conv_id", F.col("text").alias("a")
    )
    man = RT.layer_manifest(c.select("conv_id", "turn", F.col("turn").alias("layer_id")), "conv_id", "turn", "layer_id")
    j = user.join(asst, "conv_id").join(man, "conv_id")
    return j.select("conv_id", CH.assemble_layout_prompt("u", "a", "manifest").alias("layout_prompt"))


# ---------------------------------------------------------------- chat rendering


@scenario(
    "chat_render",
    f"""
WITH la AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS lat FROM conversations GROUP BY conv_id HAVING lat IS NOT NULL)
SELECT la.conv_id,
  coalesce(string_agg({_msg_sql('c.role', 'c.text')}, '' ORDER BY c.turn) FILTER (WHERE c.turn < la.lat), '') || {_GEN} AS prompt,
  arg_max(c.text, c.turn) FILTER (WHERE c.turn = la.lat) || '<|im_end|>' || chr(10) AS completion
FROM la JOIN conversations c USING (conv_id) GROUP BY la.conv_id
""",
)
def chat_render(spark, d):
    c = table(spark, d, "conversations")
    last = c.filter("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("lat"))
    j = c.join(last, "conv_id")
    msgs = j.filter(F.col("turn") < F.col("lat")).select("conv_id", "turn", CH.render_message("role", "text").alias("m"))
    body = ordered_concat(msgs, "conv_id", "turn", "m", sep="", out="body")
    comp = j.filter(F.col("turn") == F.col("lat")).select("conv_id", F.concat("text", F.lit("<|im_end|>\n")).alias("completion"))
    gen = CH.CHATML.generation_prompt
    return (
        last.join(body, "conv_id", "left")
        .join(comp, "conv_id")
        .select("conv_id", F.concat(F.coalesce("body", F.lit("")), F.lit(gen)).alias("prompt"), "completion")
    )


def _training_rows(c):
    """Per conversation: prompt = turn 0, the four plan blocks = turns 1-4
    (NULL when the conversation is shorter)."""
    aggs = [F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("prompt")]
    aggs += [F.max(F.when(F.col("turn") == i + 1, F.col("text"))).alias(b) for i, b in enumerate(PLAN_TAGS)]
    return c.groupBy("conv_id").agg(*aggs)


_TRAIN_SQL = "SELECT conv_id, " + ", ".join(
    [f"max(text) FILTER (WHERE turn = 0) AS prompt"] + [f"max(text) FILTER (WHERE turn = {i + 1}) AS {b}" for i, b in enumerate(PLAN_TAGS)]
) + " FROM conversations GROUP BY conv_id"


@scenario(
    "sft_pairs",
    f"""
WITH t AS ({_TRAIN_SQL}),
p AS (SELECT conv_id,
  {_msg_sql("'system'", sql_literal(PLANNER_SYSTEM_PROMPT))} || {_msg_sql("'user'", 'prompt')} || {_GEN} AS pr,
  layout_thought || chr(10) || grouping || chr(10) || image_generator || chr(10) || generate_text || '<|im_end|>' || chr(10) AS co
  FROM t)
SELECT conv_id, CASE WHEN pr IS NOT NULL AND co IS NOT NULL THEN 'OK' ELSE 'REJECTED_NULL_BLOCK' END AS status,
  CASE WHEN pr IS NOT NULL AND co IS NOT NULL THEN pr END AS prompt,
  CASE WHEN pr IS NOT NULL AND co IS NOT NULL THEN co END AS completion
FROM p
""",
)
def sft_pairs(spark, d):
    t = _training_rows(table(spark, d, "conversations"))
    return S.sft_pairs(t, keep=("conv_id",))


@scenario(
    "sft_budget",
    f"""
WITH p AS (SELECT doc_id, {_msg_sql("'user'", 'source')} || {_GEN} AS prompt, text || '<|im_end|>' || chr(10) AS completion FROM documents)
SELECT doc_id, CAST(length(prompt) AS BIGINT) AS prompt_len, CAST(length(completion) AS BIGINT) AS completion_len,
  length(prompt) + length(completion) > 6144 AS over_budget,
  CAST(greatest(0, least(length(completion), 6144 - length(prompt))) AS BIGINT) AS kept_completion_len
FROM p
""",
)
def sft_budget(spark, d):
    docs = table(spark, d, "documents")
    pairs = docs.select(
        "doc_id",
        CH.chat_render(F.array(CH.message("user", F.col("source")))).alias("prompt"),
        F.concat("text", F.lit("<|im_end|>\n")).alias("completion"),
    )
    return S.sft_budget(pairs).select("doc_id", "prompt_len", "completion_len", "over_budget", "kept_completion_len")


@scenario("sft_tokens")
def sft_tokens(spark, d):
    """Token counts, the cut at the training length and the loss span of
    prompt and answer pairs: each assistant turn with the turn before it."""
    import public_tokenizers

    c = table(spark, d, "conversations")
    before = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("asked"))
    pairs = c.filter("role = 'assistant'").join(before, ["conv_id", "turn"]).select("conv_id", "turn", CH.chat_render(F.array(CH.message("user", F.col("asked")))).alias("prompt"), F.concat("text", F.lit("<|im_end|>\n")).alias("completion"))
    path = public_tokenizers.path("byte_bpe_50k.json")
    made = S.sft_budget(S.sft_tokens(pairs, path, max_length=512), max_length=512, length_fn=S.token_length(path))
    return made.select("conv_id", "turn", "prompt_len", "completion_len", "over_budget", "kept_completion_len", F.size("tokens.ids").alias("n_kept"), "tokens.loss_start", "tokens.loss_end")


@scenario(
    "chat_messages",
    f"""
SELECT conv_id, turn, {_msg_sql("'system'", sql_literal(PLANNER_SYSTEM_PROMPT))} || {_msg_sql("'user'", 'text')} || {_GEN} AS rendered
FROM conversations WHERE role = 'user'
""",
)
def chat_messages(spark, d):
    c = table(spark, d, "conversations").filter("role = 'user'")
    return c.select("conv_id", "turn", CH.chat_render(CH.chat_messages(PLANNER_SYSTEM_PROMPT, "text")).alias("rendered"))


_A, _REST = CRITIQUE_TEMPLATE.split("{layout_prompt}")
_B, _C = _REST.split("{html_content}")


@scenario(
    "critique_prompt",
    f"""
SELECT item_id, {sql_literal(_A)} || text || {sql_literal(_B)} || '<div class="poster">' || CAST(item_id AS VARCHAR) || '</div>' || {sql_literal(_C)} AS prompt
FROM benchmark
""",
)
def critique_prompt(spark, d):
    b = table(spark, d, "benchmark")
    html = F.concat(F.lit('<div class="poster">'), F.col("item_id").cast("string"), F.lit("</div>"))
    return b.select("item_id", CH.critique_prompt(F.col("text"), html).alias("prompt"))


@scenario(
    "image_request",
    f"SELECT conv_id, turn, {sql_literal(IMAGE_SYSTEM_PROMPT + chr(10) + 'user: ')} || text AS request FROM conversations WHERE role = 'user'",
)
def image_request(spark, d):
    c = table(spark, d, "conversations").filter("role = 'user'")
    return c.select("conv_id", "turn", CH.image_request("text").alias("request"))


@scenario(
    "multimodal_request",
    """
SELECT item_id, CAST(3 AS BIGINT) AS n_parts,
  'text:' || text || '|text:html|image_url:data:image/png;base64,' || to_base64(encode(text)) AS flat
FROM benchmark
""",
)
def multimodal_request(spark, d):
    b = table(spark, d, "benchmark")
    parts = CH.multimodal_request([F.col("text"), F.lit("html")], [T.data_url(F.encode("text", "UTF-8"))])
    flat = F.array_join(F.transform(parts, lambda p: F.concat(p["type"], F.lit(":"), F.coalesce(p["text"], p["url"]))), "|")
    return b.select("item_id", F.size(parts).cast("bigint").alias("n_parts"), flat.alias("flat"))


# ---------------------------------------------------------------- training-set checks

_DOUBLE_GROUPING = "conv_id % 6 = 0"


def _tagged_rows(c):
    t = _training_rows(c)
    cols = {}
    for b in PLAN_TAGS:
        tagged = F.concat(F.lit(f"<{b}>"), F.col(b), F.lit(f"</{b}>"))
        if b == "grouping":
            tagged = F.when(F.expr(_DOUBLE_GROUPING), F.concat(tagged, F.lit(f"<{b}></{b}>"))).otherwise(tagged)
        cols[b] = tagged
    return t.withColumns(cols)


def _tagged_sql() -> str:
    cols = []
    for b in PLAN_TAGS:
        e = f"'<{b}>' || {b} || '</{b}>'"
        if b == "grouping":
            e = f"CASE WHEN {_DOUBLE_GROUPING} THEN {e} || '<{b}></{b}>' ELSE {e} END"
        cols.append(f"{e} AS {b}")
    return f"SELECT conv_id, prompt, {', '.join(cols)} FROM ({_TRAIN_SQL})"


def _cnt(col: str, tok: str) -> str:
    return f"len(regexp_extract_all({col}, '{tok}'))"


@scenario(
    "training_columns",
    f"WITH t AS ({_tagged_sql()}) SELECT conv_id, "
    + ", ".join(
        f"{b} IS NOT NULL AS {b}_present, coalesce({_cnt(b, '<' + b + '>')} = 1 AND {_cnt(b, '</' + b + '>')} = 1, false) AS {b}_tagged"
        for b in PLAN_TAGS
    )
    + ", "
    + " AND ".join(f"{b} IS NOT NULL AND coalesce({_cnt(b, '<' + b + '>')} = 1 AND {_cnt(b, '</' + b + '>')} = 1, false)" for b in PLAN_TAGS)
    + " AS row_ok FROM t",
)
def training_columns(spark, d):
    t = _tagged_rows(table(spark, d, "conversations"))
    return S.training_columns(t).drop("prompt", *PLAN_TAGS)


def _plan_sql() -> str:
    once = " AND ".join(f"{_cnt('plan', '<' + b + '>')} = 1 AND {_cnt('plan', '</' + b + '>')} = 1" for b in PLAN_TAGS)
    order = []
    prev = None
    for b in PLAN_TAGS:
        o, c = f"instr(plan, '<{b}>')", f"instr(plan, '</{b}>')"
        order += [f"{o} > 0", f"{c} > {o}"]
        if prev:
            order.append(f"{o} > {prev}")
        prev = c
    from atelier.constants import PY_WHITESPACE_CLASS as WS

    order.append(f"regexp_matches(plan, '(?s)</layout_thought>{WS}*<grouping>')")
    present = " AND ".join(f"{b} IS NOT NULL" for b in PLAN_TAGS)
    return f"""
WITH t AS ({_tagged_sql()}),
p AS (SELECT conv_id, concat_ws(chr(10), {', '.join(PLAN_TAGS)}) AS plan, {present} AS blocks_present FROM t),
f AS (SELECT conv_id, coalesce({once}, false) AS tags_once, coalesce({' AND '.join(order)}, false) AS tags_ordered, blocks_present FROM p)
SELECT 'blocks_present' AS rule, count(*) AS plans, count(*) FILTER (WHERE NOT blocks_present) AS failing FROM f
UNION ALL SELECT 'tags_once', count(*), count(*) FILTER (WHERE NOT tags_once) FROM f
UNION ALL SELECT 'tags_ordered', count(*), count(*) FILTER (WHERE NOT tags_ordered) FROM f
"""


@scenario("plan_report", _plan_sql())
def plan_report(spark, d):
    t = _tagged_rows(table(spark, d, "conversations"))
    present = F.lit(True)
    for b in PLAN_TAGS:
        present = present & F.col(b).isNotNull()
    plans = t.select("conv_id", F.concat_ws("\n", *PLAN_TAGS).alias("plan"), present.alias("blocks_present"))
    flags = plans.select(
        "conv_id",
        "blocks_present",
        C.tag_multiplicity(F.col("plan"))["ok"].alias("tags_once"),
        C.tag_order(F.col("plan")).alias("tags_ordered"),
    )
    return C.plan_report(flags, "conv_id", ["blocks_present", "tags_once", "tags_ordered"])


# ---------------------------------------------------------------- stage requests

_URL_A, _URL_B = "'data:image/png;base64,' || 'a' || doc_id", "'data:image/png;base64,' || 'b' || doc_id"


def _parts(user: str):
    """A request's parts as one line each: type, then text or url."""
    part = F.transform(user, lambda p: F.concat(p["type"], F.lit("="), F.coalesce(p["text"], p["url"])))
    return F.array_join(part, chr(30))


@scenario(
    "layout_request",
    f"SELECT doc_id, 'system=' || {sql_literal(LAYOUT_SYSTEM_PROMPT)} || chr(30) || 'user=' || text AS request FROM documents",
)
def layout_request(spark, d):
    messages = CH.layout_messages(F.col("text"))
    line = F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"])), chr(30))
    return table(spark, d, "documents").select("doc_id", line.alias("request"))


@scenario(
    "refine_request",
    f"""SELECT doc_id, {sql_literal(REFINE_SYSTEM_PROMPT)} AS system,
  concat_ws(chr(30), 'text=' || {sql_literal(REFINE_LEAD)}, 'text=' || text, 'image_url=' || {_URL_A}, 'image_url=' || {_URL_B}) AS parts
FROM documents""",
)
def refine_request(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.expr(_URL_A).alias("a"), F.expr(_URL_B).alias("b"))
    docs = docs.withColumn("m", CH.refine_messages("text", "a", "b"))
    return docs.select("doc_id", "m.system", _parts("m.user").alias("parts"))


@scenario(
    "key_colour_request",
    f"""SELECT doc_id, {sql_literal(ASSISTANT_SYSTEM_PROMPT)} AS system,
  'text=' || {sql_literal(KEY_COLOUR_QUESTION)} || chr(30) || 'image_url=' || {_URL_A} AS parts
FROM documents""",
)
def key_colour_request(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.expr(_URL_A).alias("a")).withColumn("m", CH.key_colour_messages("a"))
    return docs.select("doc_id", "m.system", _parts("m.user").alias("parts"))


@scenario("enhance_request", f"SELECT doc_id, {sql_literal(IMAGE_ENHANCE_PROMPT)} AS prompt, {_URL_A} AS image FROM documents")
def enhance_request(spark, d):
    docs = table(spark, d, "documents").select("doc_id", CH.enhance_request(F.expr(_URL_A)).alias("m"))
    return docs.select("doc_id", "m.*")


@scenario(
    "example_paths",
    """SELECT event_id, user_id || '/layout_prompt.txt' AS layout_prompt, user_id || '/init_result.html' AS init_html, user_id || '/after_image_refine.html' AS repaired_html,
  user_id || '/image_refine_summary.json' AS repair_summary, user_id || '/reference_' || (event_id % 3 + 1) || '.png' AS reference, user_id || '/refined_' || (event_id % 3 + 1) || '.html' AS html FROM events""",
)
def example_paths(spark, d):
    e = table(spark, d, "events").select("event_id", T.example_paths("user_id").alias("a"), T.round_paths("user_id", F.col("event_id") % 3 + 1).alias("b"))
    return e.select("event_id", "a.*", "b.*")


@scenario(
    "critic_request",
    f"""SELECT doc_id, {sql_literal(CRITIC_SYSTEM_PROMPT)} AS system,
  'text=' || replace(replace({sql_literal(CRITIQUE_TEMPLATE)}, '{{layout_prompt}}', source), '{{html_content}}', lang) || chr(30) || 'image_url=' || {_URL_A} AS parts
FROM documents""",
)
def critic_request(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.expr(_URL_A).alias("a"), CH.critic_messages("source", "lang", F.expr(_URL_A)).alias("m"))
    return docs.select("doc_id", "m.system", _parts("m.user").alias("parts"))

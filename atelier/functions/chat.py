"""Chat messages, prompt templates and request payloads as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from atelier.constants import (
    ASSISTANT_SYSTEM_PROMPT,
    CHATML_END_LINE,
    CHATML_START,
    CRITIC_SYSTEM_PROMPT,
    CRITIQUE_TEMPLATE,
    GENERATION_ROLE,
    IMAGE_ENHANCE_PROMPT,
    IMAGE_SYSTEM_PROMPT,
    KEY_COLOUR_QUESTION,
    LAYOUT_SYSTEM_PROMPT,
    REFINE_LEAD,
    REFINE_SYSTEM_PROMPT,
    RESULT_TAG,
    USER_INPUT_TAG,
)
from atelier.functions.jsonparse import json_string
from atelier.functions.text import _col

MESSAGE = "struct<role:string,content:string>"
PART = "struct<type:string,text:string,url:string>"


@dataclass(frozen=True)
class ChatTemplate:
    """How a message list is rendered to one string.

    Default is ChatML: ``<|im_start|>{role}\\n{content}<|im_end|>\\n`` per
    message and ``<|im_start|>assistant\\n`` as generation prompt.
    """

    role_prefix: str = CHATML_START
    role_suffix: str = "\n"
    message_end: str = CHATML_END_LINE
    generation_role: str = GENERATION_ROLE

    @property
    def generation_prompt(self) -> str:
        return f"{self.role_prefix}{self.generation_role}{self.role_suffix}"


CHATML = ChatTemplate()


def message(role, content) -> Column:
    """One ``{role, content}`` struct; ``role`` is a literal or a column."""
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), _col(content).cast("string").alias("content"))


def chat_messages(system: str | Column, user) -> Column:
    """``[system, user]`` message array; ``system`` is a literal or a column."""
    sys_col = F.lit(system) if isinstance(system, str) else system
    return F.array(
        F.struct(F.lit("system").alias("role"), sys_col.alias("content")),
        F.struct(F.lit("user").alias("role"), _col(user).cast("string").alias("content")),
    )


def render_message(role, content, template: ChatTemplate = CHATML) -> Column:
    return F.concat(
        F.lit(template.role_prefix), _col(role), F.lit(template.role_suffix), _col(content), F.lit(template.message_end)
    )


def chat_render(messages, template: ChatTemplate = CHATML, add_generation_prompt: bool = True) -> Column:
    """Render a message array; NULL if any message content is NULL."""
    msgs = _col(messages)
    parts = F.transform(msgs, lambda m: render_message(m["role"], m["content"], template))
    # array_join skips NULL elements; refuse them instead so a missing block
    # is never silently dropped.
    has_null = F.exists(parts, lambda p: p.isNull())
    body = F.array_join(parts, "")
    if add_generation_prompt:
        body = F.concat(body, F.lit(template.generation_prompt))
    return F.when(~has_null, body)


def critique_prompt(layout_prompt, html, template: str = CRITIQUE_TEMPLATE) -> Column:
    """Fill the review template with the layout prompt and the HTML."""
    a, rest = template.split("{layout_prompt}")
    b, c = rest.split("{html_content}")
    return F.concat(F.lit(a), _col(layout_prompt), F.lit(b), _col(html), F.lit(c))


def image_request(layer_prompt, system: str = IMAGE_SYSTEM_PROMPT) -> Column:
    return F.concat(F.lit(system + "\nuser: "), _col(layer_prompt))


def text_part(text) -> Column:
    return F.struct(F.lit("text").alias("type"), _col(text).alias("text"), F.lit(None).cast("string").alias("url"))


def image_part(url) -> Column:
    return F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), _col(url).alias("url"))


def multimodal_request(texts: list, urls: list) -> Column:
    """User content parts: the text parts in order, then the image urls."""
    return F.array(*[text_part(t) for t in texts], *[image_part(u) for u in urls])


def critic_messages(layout_prompt, html, image_url) -> Column:
    """System sentence + (review text, rendered image) as the critic request."""
    return F.struct(
        F.lit(CRITIC_SYSTEM_PROMPT).alias("system"),
        multimodal_request([critique_prompt(layout_prompt, html)], [image_url]).alias("user"),
    )


def layout_messages(layout_prompt) -> Column:
    """The request of the HTML stage, which follows the layout prompt."""
    return chat_messages(LAYOUT_SYSTEM_PROMPT, layout_prompt)


def refine_messages(html, rendered_url, reference_url) -> Column:
    """The request of a layout refinement: lead text and HTML, then the
    rendered image and the refined reference."""
    return F.struct(
        F.lit(REFINE_SYSTEM_PROMPT).alias("system"),
        multimodal_request([F.lit(REFINE_LEAD), _col(html)], [rendered_url, reference_url]).alias("user"),
    )


def enhance_request(image_url, prompt: str = IMAGE_ENHANCE_PROMPT) -> Column:
    """The image edit that a refinement round begins with: prompt and image."""
    return F.struct(F.lit(prompt).alias("prompt"), _col(image_url).alias("image"))


def key_colour_messages(image_url) -> Column:
    """The request that asks whether an image has the key colour."""
    return F.struct(
        F.lit(ASSISTANT_SYSTEM_PROMPT).alias("system"), multimodal_request([F.lit(KEY_COLOUR_QUESTION)], [image_url]).alias("user")
    )


def manifest_entry(layer_id, url) -> Column:
    """One ``{"layer_id": <id>, "url": "<url>"}`` object with ``": "`` separators."""
    return F.concat(
        F.lit('{"layer_id": '), _col(layer_id).cast("string"), F.lit(', "url": '), json_string(url), F.lit("}")
    )


def format_manifest_json(entries) -> Column:
    """JSON array text of pre-rendered entries, joined by ``", "``."""
    return F.concat(F.lit("["), F.array_join(_col(entries), ", "), F.lit("]"))


def assemble_layout_prompt(user_input, plan_text, manifest_json) -> Column:
    """User input, the plan text and the retrieval manifest in one prompt."""
    return F.concat(
        F.lit(f"<{USER_INPUT_TAG}>\n"),
        _col(user_input),
        F.lit(f"\n</{USER_INPUT_TAG}>\n"),
        _col(plan_text),
        F.lit(f"\n<{RESULT_TAG}>\n"),
        _col(manifest_json),
        F.lit(f"\n</{RESULT_TAG}>"),
    )

"""Column expressions (native Spark functions only)."""

from atelier.functions.chat import (  # noqa: F401
    CHATML,
    ChatTemplate,
    assemble_layout_prompt,
    chat_messages,
    chat_render,
    critique_prompt,
    format_manifest_json,
    image_request,
    manifest_entry,
    multimodal_request,
)
from atelier.functions.html import html_contract, render_ready  # noqa: F401
from atelier.functions.jsonparse import (  # noqa: F401
    extract_verdict,
    json_string,
    parse_block,
    parse_layers,
    strict_json,
)
from atelier.functions.text import (  # noqa: F401
    artifact_path,
    bool_verdict,
    data_url,
    elapsed_minutes,
    extract_tag,
    layer_url,
    similarity_format,
    strip,
    unbase64_payload,
)
from atelier.functions.vectors import dot, l2_normalize, norm  # noqa: F401

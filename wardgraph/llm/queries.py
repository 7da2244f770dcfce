"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from wardgraph.llm import ann, chat, decontam, lang_id, lexical, materialise, maxscore, near_dup, packing, quality, secrets, spelling, url_rules

QUERIES = {
    f.__name__: f
    for f in (
        lang_id.op1_language_id,
        decontam.op2_decontaminate,
        url_rules.op3_url_filter,
        secrets.op4_secrets,
        packing.op5_pack,
        materialise.op6_training_order,
        chat.op7_chat_format,
        ann.op8_nearest,
        near_dup.op9_near_dedup,
        quality.op10_quality,
        lexical.op11_lexical,
        maxscore.op12_top_products,
        spelling.op13_spelling,
    )
}
ORACLES = {"op2_decontaminate": decontam.OP2_SQL, "op7_chat_format": chat.OP7_SQL, "op8_nearest": ann.OP8_SQL, "op9_near_dedup": near_dup.OP9_SQL, "op11_lexical": lexical.OP11_SQL, "op12_top_products": maxscore.OP12_SQL, "op13_spelling": spelling.OP13_SQL}

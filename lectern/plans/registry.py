"""The registered queries and their oracle SQL builders."""

from __future__ import annotations

from lectern.plans import asset_queries as AQ
from lectern.plans import block_queries as BQ
from lectern.plans import build_queries as BDQ
from lectern.plans import exam_queries as EQ
from lectern.plans import record_queries as RQ
from lectern.plans import score_queries as SQ
from lectern.plans import table_queries as TBQ
from lectern.plans import text_queries as TQ

QUERIES = {
    "clean_text": TQ.q_clean_text,
    "strip_footnotes": TQ.q_strip_footnotes,
    "reorder_options": TQ.q_reorder_options,
    "normalise_question": TQ.q_normalise_question,
    "segment_lines": TQ.q_segment_lines,
    "section_info": TQ.q_section_info,
    "page_lines": TQ.q_page_lines,
    "attribute_blocks": BQ.q_attribute_blocks,
    "answer_parse": BQ.q_answer_parse,
    "chat_records": RQ.q_chat_records,
    "exam_records": RQ.q_exam_records,
    "dim_lookup": RQ.q_dim_lookup,
    "validate": RQ.q_validate,
    "validate_records": RQ.q_validate_records,
    "build_prompts": RQ.q_build_prompts,
    "jsonl_roundtrip": RQ.q_jsonl_roundtrip,
    "score_answers": SQ.q_score_answers,
    "weighted_accuracy": SQ.q_weighted_accuracy,
    "result_table": SQ.q_result_table,
    "table_markdown": TBQ.q_table_markdown,
    "table_csv": TBQ.q_table_csv,
    "insert_tables": TBQ.q_insert_tables,
    "unplaced_tables": TBQ.q_unplaced_tables,
    "table_fixes": TBQ.q_table_fixes,
    "nearby_text": AQ.q_nearby_text,
    "assign_by_position": AQ.q_assign_by_position,
    "asset_override": AQ.q_asset_override,
    "shared_assets": AQ.q_shared_assets,
    "image_uri": AQ.q_image_uri,
    "long_option_numbers": TQ.q_long_option_numbers,
    "score_missing": SQ.q_score_missing,
    "saved_images": AQ.q_saved_images,
    "build_records": BDQ.q_build_records,
    "build_problems": BDQ.q_build_problems,
    "build_images": BDQ.q_build_images,
    "exam_dataset": EQ.q_exam_dataset,
    "exam_reports": EQ.q_exam_reports,
    "quarantine": RQ.q_quarantine,
}

ORACLE = {
    "clean_text": TQ.sql_clean_text,
    "strip_footnotes": TQ.sql_strip_footnotes,
    "reorder_options": TQ.sql_reorder_options,
    "normalise_question": TQ.sql_normalise_question,
    "segment_lines": TQ.sql_segment_lines,
    "section_info": TQ.sql_section_info,
    "page_lines": TQ.sql_page_lines,
    "attribute_blocks": BQ.sql_attribute_blocks,
    "answer_parse": BQ.sql_answer_parse,
    "chat_records": RQ.sql_chat_records,
    "exam_records": RQ.sql_exam_records,
    "dim_lookup": RQ.sql_dim_lookup,
    "validate": RQ.sql_validate,
    "validate_records": RQ.sql_validate_records,
    "build_prompts": RQ.sql_build_prompts,
    "jsonl_roundtrip": RQ.sql_jsonl_roundtrip,
    "score_answers": SQ.sql_score_answers,
    "weighted_accuracy": SQ.sql_weighted_accuracy,
    "result_table": SQ.sql_result_table,
    "table_markdown": TBQ.sql_table_markdown,
    "table_csv": TBQ.sql_table_csv,
    "insert_tables": TBQ.sql_insert_tables,
    "unplaced_tables": TBQ.sql_unplaced_tables,
    "table_fixes": TBQ.sql_table_fixes,
    "nearby_text": AQ.sql_nearby_text,
    "assign_by_position": AQ.sql_assign_by_position,
    "asset_override": AQ.sql_asset_override,
    "shared_assets": AQ.sql_shared_assets,
    "image_uri": AQ.sql_image_uri,
    "long_option_numbers": TQ.sql_long_option_numbers,
    "score_missing": SQ.sql_score_missing,
    "saved_images": AQ.sql_saved_images,
    "build_records": BDQ.sql_build_records,
    "build_problems": BDQ.sql_build_problems,
    "build_images": BDQ.sql_build_images,
    "exam_dataset": EQ.sql_exam_dataset,
    "exam_reports": EQ.sql_exam_reports,
    "quarantine": RQ.sql_quarantine,
}

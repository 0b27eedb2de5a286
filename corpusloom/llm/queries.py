"""Queries of the training-data operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import container_fill, contributor_cap, cut_texts, eval_leaks, golden_record, link_groups, near_pairs, residue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": near_pairs.alike_bodies,
    "p2_found": contributor_cap.skills_beyond_share,
    "p3_found": residue.spoilt_skills,
    "p4_found": golden_record.survivors,
    "p4_voted_record": golden_record.voted_record,
    "p5_found": link_groups.skill_groups,
    "p6_containers": container_fill.document_containers,
    "p7_found": eval_leaks.leaked_items,
    "p7_leak_report": eval_leaks.leak_report,
    "p8_found": cut_texts.cut_documents,
    "p8_cut_rates": cut_texts.cut_rates,
}

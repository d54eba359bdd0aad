"""Queries of this subpackage and their SQL."""

from corpusloom.llm import boilerplate, charset, language, leaks, neardup, residue, sentences, survivor, tokens

QUERIES = {"p9_found": leaks.p9_found, "p9_leaks": leaks.p9_leaks, "p10_found": sentences.p10_found, "p8_ids": tokens.p8_ids, "p8_titled": tokens.p8_titled, "p5_found": language.p5_found, "p5_segments": language.p5_segments, "p7_found": neardup.p7_found, "p7_groups": neardup.p7_groups, "p4_found": boilerplate.p4_found, "p4_article": boilerplate.p4_article, "p1_found": residue.p1_found, "p1_reasons": residue.p1_reasons, "p2_found": charset.p2_found, "p2_repaired": charset.p2_repaired, "p3_found": survivor.p3_found, "p3_record": survivor.p3_record}
SQL: dict[str, str] = {**survivor.SQL, **neardup.SQL, **leaks.SQL}

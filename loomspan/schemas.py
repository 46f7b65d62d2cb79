"""Explicit schemas of the tables the readers make. Nothing is inferred."""

from __future__ import annotations

TERM = "struct<language:string,value:string>"
SNAK = "snaktype:string,datatype:string,datavalue:string"
QUALIFIER = f"struct<hash:string,{SNAK}>"
CLAIM = f"struct<id:string,mainsnak:struct<{SNAK}>,qualifiers:map<string,array<{QUALIFIER}>>>"
DUMP_RECORD = (
    f"id string, type string, labels map<string,{TERM}>, descriptions map<string,{TERM}>, aliases map<string,array<{TERM}>>, "
    f"sitelinks map<string,struct<site:string,title:string>>, claims map<string,array<{CLAIM}>>"
)
PAGE = "id string, title string, text string"
TITLE_ROW = "qid string, id long, title string, wikidata_title string, wikipedia_title string"
MENTIONS = "aliases array<string>, titles array<string>, qids array<string>, char_spans array<array<int>>, gold array<boolean>, sources array<string>, unswap_aliases array<string>"
SENTENCE = f"sent_idx_unq long, parent_qid string, parent_title string, doc_sent_idx int, sentence string, {MENTIONS}"

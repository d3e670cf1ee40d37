"""Record types as DDL strings, which readers and createDataFrame take."""

from __future__ import annotations

PAPER = (
    "id string, title string, abstract string, authors array<string>, published string, updated string, "
    "categories array<string>, pdf_url string, _fetch_source string, created string"
)
PAPER_FIELDS = PAPER.replace(" ", ":").replace(",:", ",")
DETECTION = "struct<language:string,class:int,needs_review:boolean,flag_reason:string>"
WARNING = "struct<step:string,acronym:string,language:string,language_class:int,message:string,error:string,timestamp:string>"
DETECTED = (
    f"paper_id string, paper struct<{PAPER_FIELDS}>, sources_checked array<string>, "
    f"sections map<string,struct<source:string,detected_languages:array<{DETECTION}>>>, warnings array<{WARNING}>"
)
NO_DETECTION = (f"paper_id string, title string, sources_checked array<string>, warnings array<{WARNING}>")
SCREENING_WARNING = ("rule string, language string, acronym string, paper_id string")
HTML_CACHE_SECTION = "struct<text:string,cleaned_text:string,detected:array<string>>"
PDF_CACHE = (
    f"paper_id string, text string, cleaned_text string, body_text string, screened_text string, detected_languages array<{DETECTION}>"
)
LANGUAGE_DATA = (
    "lang_classes map<string,array<string>>, languages_to_ignore array<string>, possible_false_positive_languages map<string,string>"
)
PDF_METADATA = (
    "filename string, title string, author string, subject string, creator string, producer string, creation_date string, page_count int"
)

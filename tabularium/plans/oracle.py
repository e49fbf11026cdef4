"""The queries as SQL for DuckDB, over the same tables: common table expressions for the derived inputs and stages, and a select for each query.

Its regular expressions have no look-around: a marker is matched with an optional captured law reference behind it, and hits with one
are undone."""

from __future__ import annotations

from ..functions import vocab
from .fixtures import ARABIC, LATIN

_D = "[0-9٠-٩۰-۹]"
_LEAD = r"^#{0,6}[ \t]*[:؛.,\-()]{0,2}[ \t]*"
_WORD = "(?:مادة|ماده|المادة|الماده)"
_BIS = r"(?:\s*\)?\s*مكرر[ةا]?(?:\s+[أ-ي][\s:\)])?\s*\)?)?"
_MARK = rf"(?m)({_LEAD}(?:\(\s*المادة\s+(?:الاولي|الثانية)\s*\)|{_WORD}\s*\(\s*{_D}+\s*\){_BIS}|{_WORD}\s+{_D}+{_BIS}))((?:[ \t\n]*من\s+(?:هذا\s+|ذلك\s+)?(?:القانون|المشروع))?)"
_ORD = r"ال[أا]ول[ىة]?|الثاني[ة]?|الثالث[ة]?|الرابع[ة]?|الخامس[ة]?|السادس[ة]?|السابع[ة]?|الثامن[ة]?|التاسع[ة]?|العاشر[ة]?|[0-9]+|[٠-٩]+"
_HEAD = rf"(?:الباب|الفصل|القسم|الكتاب|الفرع)\s+(?:{_ORD})"
_ARABIC = r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
_DIGITS = "translate({}, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789')"
_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_WC = r"len(list_filter(string_split_regex({}, '\s+'), lambda w: w <> ''))"
_CAT = "['" + "','".join([*vocab.CATEGORIES, "غير"]) + "']"

CTES: dict[str, str] = {
    "docs": "select doc_id, text, source, string_split(text, chr(10)) ls, len(string_split(text, chr(10))) n from documents",
    "corpus_raw": f"""select doc_id, n, printf('L%05d', doc_id) law_id, head || case when doc_id % 37 = 0 then b || chr(10) || b else b end || foot raw_text from (
      select doc_id, n, array_to_string(list_filter(list_transform(ls, lambda l, i: case when (doc_id + i) % 25 = 0 and n > 3 then null else
        case when doc_id % 3 = 0 and n > 3 and i = 1 then '(المادة الأولى)' when doc_id % 3 = 0 and n > 3 and i = 2 then '(المادة الثانية)'
             when i % 11 = 0 then 'مادة ' || (i - sh - 1) || ' مكرر'
             when doc_id % 2 = 0 then 'مادة (' || translate((i - sh)::varchar, '0123456789', '٠١٢٣٤٥٦٧٨٩') || ')' else 'المادة ' || (i - sh) end
        || chr(10) || translate(l, '{LATIN}', '{ARABIC}')
        || case when i % 10 = 5 then ' طبقا المادة (' || (i - 3) || ')' when i % 10 = 0 then ' وفق المادتين (' || (i - 3) || ') و(' || i || ')'
                when i % 7 = 0 then chr(10) || 'المادة 3 من هذا القانون' when i % 9 = 0 then chr(10) || 'الباب الأول' when i % 13 = 0 then chr(10) || '(الفصل الثاني)' else '' end
        || case when doc_id % 17 = 0 and i % 4 = 0 then chr(65533) else '' end || case when doc_id % 19 = 0 and i % 3 = 0 then chr(7) else '' end
        || case when doc_id % 13 = 0 and i % 2 = 0 then '  .' || repeat(chr(10), 4) else '' end || case when doc_id % 41 = 0 and i % 3 = 0 then ' فقد قضت' else '' end end), lambda p: p is not null), chr(10)) b,
      case when doc_id % 29 = 0 then 'menu نص القانون ' when doc_id % 7 = 0 then repeat('تمهيد ', 200) || chr(10) when doc_id % 31 = 0 then 'ما5 و ما 6' || chr(10) else '' end head,
      case when doc_id % 29 = 0 then chr(10) || 'Creative Commons x' else '' end foot
      from (select *, case when doc_id % 3 = 0 and n > 3 then 2 else 0 end sh from docs))""",
    "registry": """select printf('L%05d', doc_id) law_id, doc_id, n + doc_id % 5 - 2 expected_article_count, case when doc_id % 4 = 0 then list_filter(range(1, n + 1), lambda k: k % 10 = 0) else [] end repealed_articles,
      doc_id % 4 expected_chapter_headings, case when doc_id % 2 = 0 then 'L' || doc_id || '.txt' end txt_filename, 'L' || doc_id || '.pdf' pdf_filename, doc_id % 41 = 0 excluding from docs""",
    "c1": r"select *, regexp_replace(raw_text, '\x{0640}+', '', 'g') t3 from corpus_raw",
    "c2": r"select *, regexp_replace(t3, '[\x{064B}-\x{065F}\x{0670}]', '', 'g') t4 from c1",
    "c3": f"select *, translate(t4, 'أإآٱى', 'ااااي') t6, regexp_replace(translate(t4, 'أإآٱى', 'ااااي'), '{_CONTROL}', '', 'g') t7 from c2",
    "c4": r"select *, regexp_replace(t7, '[ \t\r\f]+', ' ', 'g') t8 from c3",
    "c5": r"select *, regexp_replace(t8, '\n{3,}', chr(10) || chr(10), 'g') t9 from c4",
    "clean": rf"select *, {_TRIM.format('t9')} as text from c5",
    "marked": rf"""select doc_id, n, law_id, text, regexp_replace(regexp_replace(text, '{_MARK}', chr(1) || '\1' || chr(2) || '\2' || chr(3), 'g'), '\x01([^\x02]*)\x02([^\x03]+)\x03', '\1\2', 'g') x from clean""",
    "parts": "select doc_id, law_id, text, unnest(string_split(x, chr(1))) seg, generate_subscripts(string_split(x, chr(1)), 1) - 1 k from marked",
    "placed": "select *, case when k = 0 then '' else split_part(seg, chr(2), 1) end marker, case when k = 0 then seg else replace(split_part(seg, chr(2), 2), chr(3), '') end body from parts",
    "located": "select *, coalesce(sum(length(marker) + length(body)) over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0)::bigint pos from placed",
    "judged": rf"""select l.*, k > 0 and not (r.excluding and contains({_TRIM.format(r"regexp_replace(substring(l.text, greatest(pos - 39, 1)::bigint, least(pos, 40)::bigint), '\s+', ' ', 'g')")}, 'فقد قضت')) kept from located l join registry r using (law_id)""",
    "grouped": "select *, sum(kept::int) over (partition by doc_id order by k) g from judged",
    "hits": rf"""select doc_id, law_id, g::bigint k, max(marker) filter (where kept) marker, string_agg(case when kept or k = 0 then body else marker || body end, '' order by k) body, any_value(text) as text from grouped group by doc_id, law_id, g""",
    "numbered": f"""select *, case when marker like '%الاولي%' then 1 when marker like '%الثانية%' then 2 else {_DIGITS.format(f"regexp_extract(marker, '{_D}+')")}::int end number,
      case when not regexp_matches(marker, '{_D}') then 'ordinal' when contains(marker, 'مكرر') then 'bis' when regexp_matches(marker, '{_WORD}\\s*\\(\\s*{_D}') then 'paren_digit' else 'primary' end kind from hits where k > 0""",
    "orphans": rf"select law_id, {_TRIM.format('body')} orphan from hits where k = 0",
    "found": rf"""select law_id || '_' || lpad(k::varchar, greatest(3, length(k::varchar))::int, '0') article_id, law_id, k sequence_index, number::bigint article_number, {_TRIM.format(r"regexp_replace(marker, '\s+', ' ', 'g')")} article_number_raw,
      case when kind = 'ordinal' or k < coalesce(last1, 0) then 'issuance' else 'main' end article_type, body_t as text, list_contains(r.repealed_articles, number) and kind <> 'ordinal' is_repealed, kind marker_kind, {_WC.format('body_t')}::bigint word_count, length(body_t)::bigint char_count
      from (select *, max(case when number = 1 and kind <> 'ordinal' then k end) over (partition by law_id) last1, regexp_replace({_TRIM.format('body')}, '^:\s*', '') body_t from numbered) join registry r using (law_id)""",
    "report": """select r.law_id, count(f.law_id) articles_found, any_value(r.expected_article_count)::bigint expected_article_count, count(*) filter (where article_type = 'issuance') issuance_count, count(*) filter (where article_type = 'main') main_count,
      any_value(length(o.orphan))::bigint orphan_text_chars from registry r join orphans o using (law_id) left join found f using (law_id) group by r.law_id""",
    "dups": "select law_id, 'E002' code, 'error' severity, article_number, null::varchar article_id from found where article_type = 'main' and marker_kind <> 'bis' group by law_id, article_number having count(*) > 1",
    "mains": "select distinct law_id, article_number n from found where article_type = 'main'",
    "wanted": """select law_id, unnest(range(1, upto + 1)) n, repealed_articles from (select r.law_id, any_value(r.repealed_articles) repealed_articles, greatest(any_value(r.expected_article_count) - count(*) filter (where article_type = 'issuance'), coalesce(max(article_number) filter (where article_type = 'main'), 0)) upto
      from registry r join found f using (law_id) group by r.law_id)""",
    "gaps": """select w.law_id, case when exists (select 1 from mains m where m.law_id = w.law_id and (m.n = w.n - 1 or m.n = w.n + 1)) then 'E003' else 'E001' end code, 'error' severity, w.n article_number, null::varchar article_id
      from wanted w where not list_contains(w.repealed_articles, w.n) and not exists (select 1 from mains m where m.law_id = w.law_id and m.n = w.n)""",
    "bodies": r"""select law_id, 'E004' code, 'error' severity, article_number, article_id from found where length(regexp_replace(text, '^\s+|\s+$', '', 'g')) < 5
      union all select f.law_id, 'E005', 'warning', article_number, article_id from found f join (select law_id, median(word_count) m from found where word_count > 0 group by law_id) q using (law_id) where word_count > greatest(5 * m, 500)""",
    "deviations": """select law_id, code, 'warning' severity, null::bigint article_number, null::varchar article_id from (select law_id, unnest([case when orphan_text_chars > 800 then 'E006' end, case when expected_article_count > 0 and articles_found / expected_article_count > 1.10 then 'W001' end,
      case when expected_article_count > 0 and articles_found / expected_article_count < 0.90 then 'W002' end, case when issuance_count = 0 and expected_article_count >= 50 then 'W003' end]) code from report) where code is not null""",
    "issues": "select * from dups union all select * from gaps union all select * from bodies union all select * from deviations",
    "counted": f"""select c.law_id, length(c.text)::bigint char_count, c.text, len(list_distinct(list_concat(coalesce(h.numbers, []), list_transform(regexp_extract_all(c.text, '(?:^|[^\\p{{L}}\\p{{N}}_])ما\\s{{0,3}}([0-9٠-٩۰-۹]+)', 1), lambda x: {_DIGITS.format('x')}::int))))::bigint markers,
      (len(regexp_extract_all(c.text, '{_HEAD}')) + len(regexp_extract_all(c.text, '\\({_HEAD}\\)')))::bigint heads, length(c.text) - length(regexp_replace(c.text, '{_ARABIC}', '', 'g')) arabic, length(c.text) - length(replace(c.text, chr(65533), '')) broken,
      r.expected_article_count expected, r.expected_chapter_headings expected_heads, r.txt_filename from clean c join registry r using (law_id) left join (select law_id, list(number) numbers from numbered group by law_id) h using (law_id)""",
    "shares": "select *, case when char_count > 0 then arabic / char_count else 0 end acd, case when char_count > 0 then broken / char_count else 0 end cs, case when expected > 0 then markers / expected else 0.0 end share, case when expected_heads > 0 then least(1.0, heads / expected_heads) else 1.0 end shc from counted",
    "scored": """select law_id, char_count, markers article_markers_found, heads structural_headings_found, round(greatest(0.0::double, 1.0::double - abs(1.0::double - round(share::double, 4))), 4) amd_norm, round(acd::double, 4) acd_norm, round(least(1.0::double, round(share::double, 4)), 4) eacc_norm, round(shc::double, 4) shc_norm,
      round(greatest(0.0::double, 1.0::double - round(cs::double, 4) / 0.05::double), 4) cs_norm from shares""",
    "confidence": "select *, floor((amd_norm * 0.25::double + acd_norm * 0.25::double + eacc_norm * 0.25::double + shc_norm * 0.15::double + cs_norm * 0.1::double) * 10000 + 0.5000001::double) / 10000 confidence_score from scored",
    "doubled": """select c.law_id, c.text, len(h.numbers) nh, h.numbers numbers, (select sum(length(marker) + length(body)) from grouped0 p where p.law_id = c.law_id and p.k <= coalesce(len(h.numbers), 0) // 2)::bigint cut
      from clean c left join (select law_id, list(number order by k) numbers from numbered0 group by law_id) h using (law_id)""",
    "grouped0": "select doc_id, law_id, k, marker, body from placed",
    "numbered0": f"select law_id, k, case when marker like '%الاولي%' then 1 when marker like '%الثانية%' then 2 else {_DIGITS.format(f'''regexp_extract(marker, '{_D}+')''')}::int end number from placed where k > 0",
    "articles": """select doc_id, source law_id, source || '_' || lpad((case when doc_id % 50 = 3 and rn > 1 then rn - 1 else rn end)::varchar, 6, '0') article_id, case when doc_id % 20 = 7 and rn > 1 then rn - 1 else rn end article_number, 'مادة ' || rn article_number_raw,
      case when rn <= 2 then 'issuance' else 'main' end article_type, text, case doc_id % 7 when 0 then 'bis' when 1 then 'paren_digit' else 'primary' end marker_kind, doc_id % 9 = 0 is_repealed, rn sequence_index, doc_id ordinal,
      len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''))::bigint word_count, length(text)::bigint char_count from (select *, row_number() over (partition by source order by doc_id) rn from documents)""",
    "laws": "select source law_id, count(*) n, case when length(source) % 2 = 0 then source end txt_filename from documents group by source",
    "metadata": f"""select doc_id, case when doc_id % 11 = 0 then '  ' else text[:100] end topic, case when doc_id % 13 = 0 then [] else string_split(text, ' ')[1:3] end keywords, text[:50] article_summary, {_CAT}[doc_id % 10 + 1] article_category, ['x'] legal_entities,
      case when toxic = 1 then 'failed call' end enrichment_error, case doc_id % 3 when 0 then 'completed' when 1 then 'failed' else '' end enrichment_status, case doc_id % 4 when 0 then null when 1 then 'm1' else 'm2' end enrichment_model from documents join labels using (doc_id)""",
    "enriched": "select a.*, m.* exclude (doc_id) replace (case when m.doc_id is null then 'not_reached' else m.enrichment_error end as enrichment_error) from articles a left join metadata m on a.doc_id = m.doc_id",
    "attempted": "select * from enriched where coalesce(enrichment_error, '') <> 'not_reached'",
    "trusted": "select * from enriched where enrichment_status = 'completed' or (coalesce(enrichment_status, '') = '' and coalesce(enrichment_model, '') <> '' and coalesce(enrichment_error, '') = '')",
    "merged": """select a.doc_id, a.law_id, a.article_id, case when f.article_id is not null then 'fresh' when c.article_id is not null then 'cache' else 'none' end metadata_source, case when f.article_id is not null then f.topic when c.article_id is not null then c.topic else '' end topic,
      case when f.article_id is not null then f.article_category when c.article_id is not null then c.article_category else '' end article_category, case when f.article_id is not null then f.enrichment_error when c.article_id is not null then c.enrichment_error else 'not_reached' end enrichment_error
      from articles a left join (select * from attempted where doc_id % 5 = 1 qualify row_number() over (partition by article_id order by doc_id desc) = 1) f using (article_id)
      left join (select * from (select * from attempted qualify row_number() over (partition by article_id order by doc_id desc) = 1) where enrichment_status = 'completed' or (coalesce(enrichment_status, '') = '' and coalesce(enrichment_model, '') <> '' and coalesce(enrichment_error, '') = '')) c using (article_id)""",
    "corpus_found": f"""select law_id, article_id, unnest(case when coalesce(enrichment_error, '') <> '' then [{{'code': 'V003', 'field': 'enrichment_error', 'severity': 'error'}}] else list_filter([
      case when trim(coalesce(topic, '')) = '' then {{'code': 'V001', 'field': 'topic', 'severity': 'error'}} end, case when trim(coalesce(article_summary, '')) = '' then {{'code': 'V001', 'field': 'article_summary', 'severity': 'error'}} end,
      case when trim(coalesce(article_category, '')) = '' then {{'code': 'V001', 'field': 'article_category', 'severity': 'error'}} end, case when len(keywords) = 0 then {{'code': 'V005', 'field': 'keywords', 'severity': 'warning'}} end,
      case when article_category = 'غير' then {{'code': 'V002', 'field': 'article_category', 'severity': 'warning'}} end,
      case when (article_number % 10 = 0 and article_number <= 100) <> is_repealed then {{'code': 'V004', 'field': 'is_repealed', 'severity': 'warning'}} end], lambda x: x is not null) end, recursive := true) from enriched""",
    "last_rows": "select *, min(ordinal) over (partition by article_id) first_ordinal, row_number() over (partition by article_id order by ordinal desc) back from articles",
    "assembled": """select *, row_number() over (partition by law_id order by article_type = 'issuance', article_number, first_ordinal) release_rank from (select * exclude (is_repealed), article_number % 10 = 0 and article_number <= 100 is_repealed, article_number % 10 = 0 and article_number <= 100 and not is_repealed newly from last_rows where back = 1)""",
    "ledger": """select event_type stage, user_id::varchar law_id, event_id % 5000 input_tokens, round(value * 100)::bigint output_tokens, event_id % 3 image_pages, '****' || right('key' || (user_id % 4), 3) api_key_suffix,
      (event_id % 5000) / 1000000.0::double * 0.1::double + round(value * 100)::bigint / 1000000.0::double * 0.4::double + (event_id % 3) * 0.00258::double cost from events""",
}

_WORDS = r"list_filter(string_split_regex({}, '\s+'), lambda w: w <> '')"
#: Chunks of texts in ``chunk_in`` (id, law_id, text), whose paragraphs are separated by two line feeds.
CHUNK_CTES: dict[str, str] = {
    "texts": rf"select id, law_id, {_TRIM.format('text')} as text, len({_WORDS.format('text')}) wc from chunk_in where {_TRIM.format('text')} <> ''",
    "paras": rf"select id, unnest(list_filter(list_transform(string_split_regex(text, '\n{{2,}}'), lambda p: {_TRIM.format('p')}), lambda p: p <> '')) p, generate_subscripts(list_filter(list_transform(string_split_regex(text, '\n{{2,}}'), lambda p: {_TRIM.format('p')}), lambda p: p <> ''), 1) a from texts where wc > 250",
    "segs": rf"select id, a, unnest(ss) s, generate_subscripts(ss, 1) b from (select id, a, case when len({_WORDS.format('p')}) > 250 then list_filter(list_transform(string_split(regexp_replace(p, '([.،؟!])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: {_TRIM.format('x')}), lambda x: x <> '') else [p] end ss from paras)",
    "rows_": rf"select id, row_number() over (partition by id order by a, b) k, {_WORDS.format('s')} ws from segs",
    "fold": "select id, k, len(ws)::bigint cur, 1::bigint g from rows_ where k = 1 union all select r.id, r.k, case when f.cur > 0 and f.cur + len(r.ws) > 250 then len(r.ws) else f.cur + len(r.ws) end, case when f.cur > 0 and f.cur + len(r.ws) > 250 then f.g + 1 else f.g end from fold f join rows_ r on r.id = f.id and r.k = f.k + 1",
    "raw_": "select r.id, g, flatten(list(ws order by r.k)) ws from rows_ r join fold f on f.id = r.id and f.k = r.k group by r.id, g",
    "laps": "select id, g, ws, lag(ws) over (partition by id order by g) before from raw_",
    "chunks": r"""select t.id, t.law_id, 0::bigint chunk_index, t.text as text, false has_overlap, t.wc::bigint word_count from texts t where wc <= 250
      union all select l.id, t.law_id, g - 1, array_to_string(case when before is null then ws else list_concat(before[greatest(len(before) - 29, 1):], ws) end, ' '), before is not null, (len(ws) + case when before is null then 0 else least(30, len(before)) end)::bigint from laps l join texts t using (id)""",
}


def _needs(sql: str, among: dict[str, str]) -> list[str]:
    """The expressions that a statement refers to, in the order of their definitions' dependencies."""
    import re

    out: list[str] = []

    def visit(text: str) -> None:
        for name in among:
            if name not in out and re.search(rf"\b(?:from|join)\s+\(?\s*{name}\b", text):
                visit(among[name].replace(f"from {name} ", "from _ ") if name == "fold" else among[name])
                if name not in out:
                    out.append(name)

    visit(sql)
    return out


def _sql(select: str, chunk_in: str | None = None) -> str:
    among = CTES | (CHUNK_CTES | {"chunk_in": chunk_in} if chunk_in else {})
    if chunk_in:
        among = {"chunk_in": chunk_in, **{k: v for k, v in among.items() if k != "chunk_in"}}
    named = _needs(select, among)
    head = ", ".join(f"{n} as ({among[n]})" for n in named)
    return f"with recursive {head} {select}" if named else select


# Reference phrases of the derived corpus: two forms, and rejected markers within bodies. A number counts where it comes first in its article.
_SPAN = rf"(?:المواد|المادتين|المادة)\s*\(?(?:[٠-٩۰-۹0-9]{{1,4}})?\)?(?:\s*[،,و\s]+\(?(?:[٠-٩۰-۹0-9]{{1,4}})?\)?)*"
CTES["spans"] = f"select law_id, article_id, sequence_index, unnest(l) s, generate_subscripts(l, 1) i from (select *, list_filter(regexp_extract_all(text, '{_SPAN}'), lambda x: regexp_matches(x, '{_D}')) l from found)"
CTES["refs_all"] = f"select *, unnest(regexp_extract_all(s, '[٠-٩۰-۹0-9]{{1,4}}')) d, generate_subscripts(regexp_extract_all(s, '[٠-٩۰-۹0-9]{{1,4}}'), 1) j from spans"
CTES["refs_new"] = f"select law_id, article_id, i, any_value(s) s, list(num order by j) nums from (select *, {_DIGITS.format('d')}::int num from refs_all where {_DIGITS.format('d')}::int between 1 and 9999 qualify row_number() over (partition by article_id, {_DIGITS.format('d')}::int order by i, j) = 1) group by law_id, article_id, i"
CTES["refs"] = rf"select law_id, article_id, row_number() over (partition by article_id order by i) - 1 ref_no, {_TRIM.format(r"regexp_replace(regexp_replace(s, '\s+', ' ', 'g'), '[\s،,وأ]+$', '')")} ref_text, nums from refs_new"
CTES["targets"] = "select law_id, article_number num, article_id target from found qualify row_number() over (partition by law_id, article_number order by article_type = 'issuance' desc, sequence_index desc) = 1"
CTES["dangling"] = """select r.law_id, r.article_id, r.number::bigint number, coalesce(t.repealed, false) repealed from (select distinct law_id, article_id, unnest(nums) number from refs_new) r
      left join (select law_id, article_number number, bool_and(is_repealed) repealed from found group by all) t on r.law_id = t.law_id and r.number = t.number where t.repealed is null or t.repealed"""
CTES["ref_edges"] = "select distinct r.law_id, r.article_id, t.target from (select law_id, article_id, unnest(nums) num from refs_new) r join targets t using (law_id, num) where t.target <> r.article_id"
CTES["reaching"] = """with recursive e as materialized (select * from ref_edges), t as (select distinct law_id, article_id from dangling union select e.law_id, e.article_id from t join e on e.law_id = t.law_id and e.target = t.article_id) select * from t"""

_DOC_CHUNKS = "select doc_id::varchar id, source law_id, replace(text, chr(10), chr(10) || chr(10)) as text from documents"
_ENRICHED_CHUNKS = "select doc_id::varchar id, law_id, text from enriched"
_ARTICLE_CHUNKS = "select doc_id::varchar id, law_id, text from articles"
_MEAN = "case when {1} > 0 then round({0} / {1}::double, 1) else 0.0::double end"

_VERSIONS = """select *, lead(valid_from) over (partition by law_id order by version_no) valid_to from (select *, row_number() over (partition by law_id order by valid_from, version_id) version_no
  from (select printf('L%05d', doc_id // 4) law_id, doc_id version_id, date '2000-01-01' + (doc_id * 37 % 1000 // 7 * 7)::int valid_from from documents))"""
_LINES = f"select law_id, version_no, version_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) number from ({_VERSIONS}) join documents on doc_id = version_id"

_SELECTS: dict[str, str | tuple[str, str]] = {
    "cleanup_audit": "select law_id, length(raw_text)::bigint chars_before, length(text)::bigint chars_after, (length(raw_text) - length(text))::bigint chars_removed, 0::bigint presentation_forms_normalized, (abs(length(raw_text) - length(nfc_normalize(raw_text))) + len(list_filter(list_zip(regexp_extract_all(raw_text, '(?s).'), regexp_extract_all(nfc_normalize(raw_text), '(?s).'), true), lambda x: x[1] <> x[2])))::bigint nfc_changed, (length(raw_text) - length(t3))::bigint tatweel_removed, (length(t3) - length(t4))::bigint diacritics_removed, (length(t4) - length(regexp_replace(t4, '[أإآٱ]', '', 'g')))::bigint hamza_normalised, (length(t4) - length(replace(t4, 'ى', '')))::bigint yeh_normalised, (length(t6) - length(t7))::bigint control_removed, (length(t7) - length(t8))::bigint spaces_collapsed, (length(t8) - length(t9))::bigint newlines_collapsed from clean",
    "clean_text_hash": "select law_id, md5(text) text_md5 from clean",
    "normalize_text": rf"select law_id, md5({_TRIM.format(rf'''regexp_replace(regexp_replace(regexp_replace(translate(t4, 'أإآٱىئ', 'اااايي'), '{_CONTROL}', '', 'g'), '[ \t\r\f]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')''')}) text_md5 from c2",
    "char_density": f"select law_id, round((length(raw_text) - length(regexp_replace(raw_text, '{_ARABIC}', '', 'g'))) / length(raw_text)::double, 6) arabic, round((length(raw_text) - length(replace(raw_text, chr(65533), ''))) / length(raw_text)::double, 6) replacement from corpus_raw",
    "marker_hits": "select law_id, k, number::bigint number, kind from numbered",
    "marker_counts_distinct": "select law_id, markers from counted",
    "heading_counts": "select law_id, heads headings from counted",
    "boilerplate_strip": rf"select law_id, md5({_TRIM.format('''case when doc_id % 29 = 0 then split_part(substring(raw_text, instr(raw_text, 'نص القانون') + 10), 'Creative Commons', 1) else raw_text end''')}) text_md5 from corpus_raw",
    "presentation_forms_route": "select doc_id, round(k / length(t)::double, 6) share, k / length(t)::double >= 0.01 folded, k / length(t)::double >= 0.01 folded_early from (select doc_id, case when doc_id % 23 = 0 then doc_id % 90 else 0 end k, text || repeat('ﺍ', (case when doc_id % 23 = 0 then doc_id % 90 else 0 end)::bigint) t from documents)",
    "articles_split": "select article_id, law_id, article_number, article_number_raw, article_type, md5(text) text_md5, is_repealed, sequence_index, marker_kind, word_count, char_count from found",
    "orphan_text": "select law_id, length(orphan)::bigint orphan_chars, length(orphan) > 800 \"large\" from orphans",
    "issuance_reclassify": "select law_id, count(*) filter (where article_type = 'issuance' and marker_kind <> 'ordinal') reclassified, count(*) filter (where article_type = 'issuance') issuance, count(*) filter (where article_type = 'main') main from found group by law_id",
    "manual_exclusions": "select g.law_id, count(*) filter (where k > 0) all_hits, count(*) filter (where kept) kept_hits from grouped g join registry r using (law_id) where r.excluding group by g.law_id",
    "marker_kind_histogram": "select law_id, marker_kind, count(*) n from found group by all",
    "split_report": "select * from report",
    "missing_and_gaps": "select law_id, code, article_number from gaps",
    "duplicate_articles": "select law_id, article_number from dups",
    "empty_oversized": "select law_id, code, article_number, article_id from bodies",
    "count_deviation": "select law_id, code from deviations",
    "split_gate": "select r.law_id, count(*) filter (where severity = 'error') errors, count(*) filter (where severity = 'warning') warnings, count(*) filter (where severity = 'error') = 0 passed from registry r left join issues i using (law_id) group by r.law_id",
    "confidence_score": "select *, confidence_score >= 0.85 passed from confidence",
    "confidence_factors": "select law_id, f.factor factor, f.norm norm, f.weight weight, floor(f.norm * f.weight * 10000 + 0.5000001::double) / 10000 contribution from (select law_id, unnest([{'factor': 'amd', 'norm': amd_norm, 'weight': 0.25::double}, {'factor': 'acd', 'norm': acd_norm, 'weight': 0.25::double}, {'factor': 'eacc', 'norm': eacc_norm, 'weight': 0.25::double}, {'factor': 'shc', 'norm': shc_norm, 'weight': 0.15::double}, {'factor': 'cs', 'norm': cs_norm, 'weight': 0.1::double}]) f from scored)",
    "duplication_strip": r"select law_id, twice stripped, length(case when twice then regexp_replace(substring(text, 1, cut), '\s+$', '') else text end)::bigint chars, length(text)::bigint original_chars, (case when twice then nh // 2 else 0 end)::bigint duplicate_marker_count from (select *, coalesce(nh >= 10 and nh % 2 = 0 and numbers[1:nh // 2] = numbers[nh // 2 + 1:] and (length(text) - cut) / greatest(cut, 1)::double between 0.6 and 1.5, false) twice from doubled)",
    "cross_refs": "select article_id, ref_no, ref_text, array_to_string(nums, ',') numbers, true same_law from refs",
    "cross_refs_resolved": "select article_id, ref_no, string_agg(target, ',' order by j) targets from (select r.article_id, r.ref_no, r.law_id, unnest(nums) num, generate_subscripts(nums, 1) j from refs r) r left join targets t using (law_id, num) group by article_id, ref_no",
    "refs_dangling": "select law_id, article_id, number, repealed from dangling",
    "refs_reachable": """select law_id, article_id, (law_id, article_id) in (select (law_id, article_id) from dangling) itself from reaching""",
    "reply_log": """select law_id, batch, count(*) "count", case when count(*) filter (where doc_id % 100 in (13, 77)) > 0 then 2 else 1 end::bigint calls, case when count(*) filter (where doc_id % 100 in (13, 77)) > 0 then 1 else 0 end::bigint refused, true answered
      from numbered_batches group by law_id, batch""",
    "chunks_rule": ("select id article_id, chunk_index, count(*) over (partition by id) chunk_total, md5(text) text_md5, has_overlap, word_count, length(text)::bigint char_count from chunks", _DOC_CHUNKS),
    "chunk_stats": ("select law_id, count(*) total_chunks, round(sum(word_count)::double / count(*), 1) avg_chunk_words, max(word_count) max_chunk_words, min(word_count) min_chunk_words, 0::bigint semantic_chunks, count(*) rule_based_chunks from chunks group by law_id", _DOC_CHUNKS),
    "chunk_single_multi": ("select law_id, count(*) filter (where n = 1) single_chunk_articles, count(*) filter (where n > 1) multi_chunk_articles from (select law_id, id, count(*) n from chunks group by all) group by law_id", _DOC_CHUNKS),
    "chunks_semantic_fallback": rf"select doc_id::varchar article_id, case when m then 'semantic' else 'rule_based' end chunk_method, case when m then k else 0 end semantic_chunks from (select doc_id, doc_id % 4 = 3 and {_WC.format('text')} > 250 m, (case when {_TRIM.format('''substring(text, 1, length(text) // 2)''')} <> '' then 1 else 0 end + case when {_TRIM.format('''substring(text, length(text) // 2 + 1)''')} <> '' then 1 else 0 end)::bigint k from documents)",
    "enrich_worklist": "select article_id, doc_id from articles where article_id not in (select article_id from trusted)",
    "enrich_batches": rf"""select law_id, batch, count(*) count, length(p)::bigint prompt_chars, md5(p) prompt_md5 from (select law_id, batch, count(*) c, '<articles law="' || law_id || '" count="' || count(*) || '">' || chr(10) || string_agg('  <article id="' || article_id || '" type="' || article_type || '" words="' || word_count || '">' || chr(10) || {_TRIM.format('text')} || chr(10) || '  </article>', chr(10) order by sequence_index) || chr(10) || '</articles>' p from (select *, (row_number() over (partition by law_id order by sequence_index) - 1) // 150 batch from articles) group by law_id, batch) group by all""".replace("count(*) count, length", "any_value(c) count, length").replace(" group by all", " group by law_id, batch, p"),
    "enrich_subbatches": "select law_id, batch, part, count(*) n, min(doc_id) first_doc from (select *, (row_number() over (partition by law_id, batch order by sequence_index) - 1) // greatest(2, count(*) over (partition by law_id, batch) // 2) part, count(*) over (partition by law_id, batch) c from (select *, (row_number() over (partition by law_id order by sequence_index) - 1) // 150 batch from articles) where batch % 3 = 0) where c > 1 group by law_id, batch, part",
    "metadata_coercion": "select doc_id::varchar article_id, topic, array_to_string(list_transform(keywords, lambda k: k[:80]), '|') keywords, article_summary, case when article_category = 'غير' then 'أخرى' else article_category end article_category, case when doc_id % 4 = 0 then 'consent' else 'consent|void_contract' end concepts, 'civil|digital' applicable_to from metadata where doc_id % 17 <> 0",
    "enriched_merge": "select doc_id, article_id, metadata_source, topic, article_category, enrichment_error from merged",
    "enrichment_report": "select law_id, count(*) total_articles, count(*) filter (where metadata_source = 'fresh' and coalesce(enrichment_error, '') = '') enriched, count(*) filter (where metadata_source = 'cache') skipped_cache, count(*) filter (where metadata_source = 'fresh' and coalesce(enrichment_error, '') <> '') failed from merged group by law_id",
    "enrichment_replies": "select article_id, count(*) n, 'أخرى' article_category from articles group by article_id",
    "review_articles": ("select e.article_id, e.law_id, article_number, article_number_raw, article_type, article_category, topic, coalesce(array_to_string(keywords, ' | '), '') keywords, coalesce(array_to_string(legal_entities, ' | '), '') legal_entities, article_summary, is_repealed, e.word_count, e.char_count, coalesce(c.n, 0) chunk_count, coalesce(enrichment_error, '') enrichment_error, '' review_status, '' review_notes, md5(e.text) \"text\" from enriched e left join (select article_id, count(*) n from chunks join enriched on id = doc_id::varchar group by article_id) c using (article_id)", _ENRICHED_CHUNKS),
    "review_chunks": ("select article_id || '_C' || lpad((chunk_index + 1)::varchar, 3, '0') chunk_id, article_id, chunk_index, count(*) over (partition by id) chunk_total, coalesce(array_to_string(keywords, ' | '), '') keywords, coalesce(array_to_string(legal_entities, ' | '), '') legal_entities, article_category, '' review_status, md5(c.text) text_md5 from chunks c join enriched e on id = doc_id::varchar", _ENRICHED_CHUNKS),
    "review_stats": ("select e.law_id, count(*) total_articles, count(*) filter (where article_type = 'issuance') issuance_articles, count(*) filter (where article_type <> 'issuance') main_articles, count(*) filter (where coalesce(enrichment_error, '') <> '') enrichment_errors, sum(coalesce(c.n, 0))::bigint total_chunks, count(*) filter (where c.n > 1) multi_chunk_articles, count(*) filter (where coalesce(c.n, 0) <= 1) single_chunk_articles from enriched e left join (select article_id, count(*) n from chunks join enriched on id = doc_id::varchar group by article_id) c using (article_id) group by e.law_id", _ENRICHED_CHUNKS),
    "review_priority": """select row_number() over (order by priority desc, law_id, sequence_index) review_rank, article_id, doc_id, priority from (select e.law_id, e.article_id, doc_id, sequence_index,
      coalesce(100 * errors + 10 * warnings, 0)::bigint + case when l.txt_filename is null then 20 else 0 end priority from enriched e left join laws l using (law_id)
      left join (select article_id, count(*) filter (where severity = 'error') errors, count(*) filter (where severity = 'warning') warnings from corpus_found group by article_id) i using (article_id))""",
    "bisect_calls": """select law_id, batch, count(*) calls, max(level) + 1 levels, count(*) filter (where list_contains(l, true)) failed, sum(len(l))::bigint asked, any_value(n) - any_value(bad) answered from nodes group by law_id, batch""",
    "nearest_exact": """select query_id, rank, vec_id, round(distance, 6) distance from (select *, row_number() over (partition by query_id order by distance, vec_id) rank from (select q.vec_id query_id, e.vec_id,
      list_sum(list_transform(list_zip(q.embedding, e.embedding), lambda p: (p[1]::double - p[2]::double) * (p[1]::double - p[2]::double))) distance from embeddings q, embeddings e where q.vec_id % 100 = 0 and e.vec_id <> q.vec_id)) where rank <= 10""",
    "corpus_issues": "select law_id, article_id, code, field, severity from corpus_found",
    "issue_summary": "select code, count(*) n, count(*) filter (where severity = 'error') errors, count(*) filter (where severity = 'warning') warnings from corpus_found group by code",
    "corpus_gate": "select l.law_id, count(*) filter (where severity = 'error') errors, count(*) filter (where severity = 'warning') warnings, count(*) filter (where severity = 'error') = 0 passed from laws l left join corpus_found c using (law_id) group by l.law_id",
    "assemble_dedup": "select law_id, i total_articles_in, o total_articles_out, i - o duplicates_removed, f repealed_flagged from (select law_id, count(*) i from articles group by law_id) join (select law_id, count(*) o, count(*) filter (where newly) f from assembled group by law_id) using (law_id)",
    "assemble_articles": "select article_id, a.law_id, article_number, doc_id, is_repealed, release_rank, true is_current_version, '1.1' schema_version, case when l.txt_filename is null then 'gemini_ocr' else 'text_file' end extraction_source, round(length(a.law_id) / 7.0::double, 4) confidence_score from assembled a join laws l using (law_id)",
    "chunk_repealed": ("select c.law_id, coalesce(g.gone, false) is_repealed, count(*) n from chunks c join articles a on c.id = a.doc_id::varchar left join (select article_id, true gone from assembled where is_repealed) g using (article_id) group by all", _ARTICLE_CHUNKS),
    "release_stats": (f"select law_id, total_articles, active_articles, issuance_articles, repealed_articles, total_article_words, coalesce(total_chunks, 0) total_chunks, coalesce(total_chunk_words, 0)::bigint total_chunk_words, {_MEAN.format('total_article_words', 'total_articles')} avg_words_per_article, {_MEAN.format('coalesce(total_chunk_words, 0)', 'coalesce(total_chunks, 0)')} avg_words_per_chunk from (select law_id, count(*) total_articles, count(*) filter (where article_type = 'main' and not is_repealed) active_articles, count(*) filter (where article_type = 'issuance') issuance_articles, count(*) filter (where is_repealed) repealed_articles, sum(word_count)::bigint total_article_words from assembled group by law_id) left join (select law_id, count(*) total_chunks, sum(word_count) total_chunk_words from chunks group by law_id) using (law_id)", _ARTICLE_CHUNKS),
    "category_histogram": "select law_id, coalesce(article_category, 'أخرى') article_category, count(*) n from articles left join metadata using (doc_id) group by all",
    "models_used": "select law_id, coalesce(enrichment_model, 'unknown') enrichment_model, count(*) n from enriched group by all",
    "cost_by_stage": "select stage, count(*) calls, sum(input_tokens)::bigint input_tokens, sum(output_tokens)::bigint output_tokens, sum(image_pages)::bigint image_pages, round(sum(cost), 6) cost_usd from ledger group by stage",
    "cost_by_key": "select api_key_suffix, count(*) calls, sum(input_tokens)::bigint input_tokens, sum(output_tokens)::bigint output_tokens, sum(image_pages)::bigint image_pages, round(sum(cost), 6) cost_usd from ledger group by api_key_suffix",
    "batch_summary": "select law_id, sum(case when ok then a else 0 end)::bigint articles, sum(case when ok then c else 0 end)::bigint chunks, floor(sum(cost) * 10000 + 0.5000001::double) / 10000 cost_usd, count(*) filter (where ok) ok, count(*) laws from (select law_id, count(*) a, sum(image_pages) c, sum(cost) cost, law_id::bigint % 11 <> 0 and law_id::bigint % 7 <> 0 and law_id::bigint % 5 <> 0 and law_id::bigint % 3 <> 0 ok from ledger group by law_id) group by rollup (law_id)",
    "upsert_merge": "select doc_id, law_id, char_count, case when doc_id % 2 = 0 then 2 else 1 end::bigint as version from articles where doc_id % 2 = 0 or doc_id % 3 <> 0",
    "unique_violations": "select law_id, article_number, count(*) n from articles group by all having count(*) > 1",
    "unicode_composition": "select doc_id, length(c)::bigint chars, md5(c) text_md5, c <> t changed from (select doc_id, t, nfc_normalize(t) c from (select doc_id, coalesce(case doc_id % 3 when 0 then replace(text, 'e', 'e' || chr(769)) when 1 then replace(text, 'a', chr(1575) || chr(1619) || chr(1617) || chr(1614)) else text end, '') t from documents))",
    "page_ranges": "select page_id, page_id % 9 = 0 or (n >= 10 and (c % 20000) / n::double < 150) truncated, s::bigint start, least(s + 15, n)::bigint stop from (select page_id, length(html) c, length(html) // 300 n, unnest(range(0, length(html) // 300, 15)) s from pages)",
    "error_classify": "select ['daily_quota', 'rate_limit', 'invalid_key', 'rate_limit', 'transient', 'other'][event_id % 6 + 1] class, count(*) n from events group by all",
    "source_resolution": "select law_id, coalesce(txt_filename, pdf_filename) source, doc_id % 6 <> 1 there, case when txt_filename is not null then 'a|' || law_id else pdf_filename end keys, case when txt_filename is not null then '****a|****' || right(law_id, 3) else '****pdf' end masked from registry",
    "quick_confidence_route": "select q.law_id, q.quick, case when txt_filename is not null then 'plaintext' when substring(q.law_id, 6, 1) = '5' then 'cached' when quick >= 0.85 then 'pymupdf' else 'gemini_ocr' end || case when d.twice then '+dedup_stripped' else '' end route from (select law_id, txt_filename, case when char_count < 200 then 0.0::double else floor((greatest(0.0::double, 1.0::double - abs(1.0::double - share::double)) * 0.25::double + acd::double * 0.25::double + least(1.0::double, share::double) * 0.25::double + shc::double * 0.15::double + greatest(0.0::double, 1.0::double - cs::double / 0.05::double) * 0.1::double) * 10000 + 0.5000001::double) / 10000 end quick from shares) q join (select law_id, coalesce(nh >= 10 and nh % 2 = 0 and numbers[1:nh // 2] = numbers[nh // 2 + 1:] and (length(text) - cut) / greatest(cut, 1)::double between 0.6 and 1.5, false) twice from doubled_kept) d using (law_id)",
}
CTES["numbered_batches"] = "select law_id, doc_id, sequence_index, (row_number() over (partition by law_id order by sequence_index) - 1) // 150 batch from articles"
CTES["nodes"] = """with recursive t(law_id, batch, l, level, n, bad) as (select law_id, batch, list(doc_id % 100 in (13, 77) order by sequence_index), 0::bigint, count(*), count(*) filter (where doc_id % 100 in (13, 77)) from numbered_batches group by law_id, batch
      union all select law_id, batch, unnest([l[1:len(l) // 2], l[len(l) // 2 + 1:]]), level + 1, n, bad from t where len(l) > 1 and list_contains(l, true)) select * from t"""
CTES["doubled_kept"] = """select c.law_id, c.text, len(h.numbers) nh, h.numbers numbers, (select sum(coalesce(length(marker), 0) + length(body)) from hits p where p.law_id = c.law_id and p.k <= coalesce(len(h.numbers), 0) // 2)::bigint cut
      from clean c left join (select law_id, list(number order by k) numbers from numbered group by law_id) h using (law_id)"""
_SHARE = "((articles_found * 1000 // expected_article_count + EXTRA) // 10)::varchar || '.' || ((articles_found * 1000 // expected_article_count + EXTRA) % 10)::varchar || '%'".replace(
    "EXTRA", "case when articles_found * 1000 % expected_article_count * 2 > expected_article_count or (articles_found * 1000 % expected_article_count * 2 = expected_article_count and articles_found * 1000 // expected_article_count % 2 = 1) then 1 else 0 end"
)
_MEDIANS = "(select law_id, median(word_count) m from found where word_count > 0 group by law_id) q"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_SPLIT = {code: _text(form) for code, (_, form) in vocab.SPLIT_ISSUES.items()}
_CORPUS = {code: _text(form) for code, form in vocab.CORPUS_ISSUES.items()}
_NAMES = ", ".join(f"('{code}', '{name}')" for code, (name, _) in vocab.SPLIT_ISSUES.items())
_WORDS = r"list_transform(list_filter(list_concat(string_split(coalesce(text, ''), ' ')[1:8], [' Void Contract', ' ']), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g') <> ''), lambda x: replace(lower(regexp_replace(x, '^\s+|\s+$', '', 'g')), ' ', '_'))"
_KNOWN = "('void_contract', 'the', 'de', 'la', 'und')"
_SELECTS |= {
    "split_issue_texts": f"""select i.law_id, i.code, i.severity, i.article_number, i.article_id, n.name, t.description from issues i join (values {_NAMES}) n (code, name) on n.code = i.code left join (
      select law_id, 'E002' code, article_number, null article_id, printf({_SPLIT["E002"]}, article_number, count(*), '[''' || string_agg(article_id, ''', ''' order by sequence_index) || ''']') description
        from found where article_type = 'main' and marker_kind <> 'bis' group by law_id, article_number having count(*) > 1
      union all select law_id, code, article_number, null, case code when 'E003' then printf({_SPLIT["E003"]}, article_number) else printf({_SPLIT["E001"]}, article_number) end from gaps
      union all select law_id, 'E004', article_number, article_id, printf({_SPLIT["E004"]}, length(text)) from found
      union all select f.law_id, 'E005', article_number, article_id, printf({_SPLIT["E005"]}, article_number, word_count, round_even(m, 0)::bigint, round_even(greatest(5 * m, 500), 0)::bigint) from found f join {_MEDIANS} on q.law_id = f.law_id
      union all select law_id, 'E006', null, null, printf({_SPLIT["E006"]}, orphan_text_chars) from report
      union all select law_id, 'W001', null, null, printf({_SPLIT["W001"]}, articles_found, expected_article_count, {_SHARE}) from report where expected_article_count > 0
      union all select law_id, 'W002', null, null, printf({_SPLIT["W002"]}, articles_found, expected_article_count, {_SHARE}) from report where expected_article_count > 0
      union all select law_id, 'W003', null, null, printf({_SPLIT["W003"]}, expected_article_count) from report
      ) t on t.law_id = i.law_id and t.code = i.code and t.article_number is not distinct from i.article_number and t.article_id is not distinct from i.article_id""",
    "corpus_issue_texts": f"""select law_id, article_id, code, field, case code when 'V003' then printf({_CORPUS["V003"]}, enrichment_error) when 'V001' then printf({_CORPUS["V001"]}, field) when 'V005' then {_CORPUS["V005"]}
      when 'V002' then printf({_CORPUS["V002"]}, article_category, {_text("['" + "', '".join(sorted(vocab.CATEGORIES)) + "']")})
      else printf({_CORPUS["V004"]}, case when is_repealed then 'True' else 'False' end, case when is_repealed then 'active' else 'repealed' end) end message
      from ({CTES["corpus_found"].replace("select law_id, article_id, unnest", "select *, unnest", 1)})""",
    "first_errors": "select law_id, article_id, code, field from corpus_found where severity = 'error' order by law_id, article_id, code, field limit 10",
    "confidence_breakdown": """select law_id, f.factor factor, f.raw raw, f.norm norm, f.weight weight, floor(f.norm * f.weight * 10000 + 0.5000001::double) / 10000 contribution from (select law_id, unnest([
      {'factor': 'amd', 'raw': raw_amd, 'norm': amd_norm, 'weight': 0.25::double}, {'factor': 'acd', 'raw': acd_norm, 'norm': acd_norm, 'weight': 0.25::double}, {'factor': 'eacc', 'raw': eacc_norm, 'norm': eacc_norm, 'weight': 0.25::double},
      {'factor': 'shc', 'raw': shc_norm, 'norm': shc_norm, 'weight': 0.15::double}, {'factor': 'cs', 'raw': raw_cs, 'norm': cs_norm, 'weight': 0.1::double}]) f from scored join (select law_id, round(share::double, 4) raw_amd, round(cs::double, 4) raw_cs from shares) using (law_id))""",
    "enrichment_run_report": """select law_id, total_articles, enriched, skipped_cache, failed, coalesce(n, 0) total_api_calls, coalesce(c, 0.0::double) total_cost_usd, 'primary' model, 150::bigint batch_size from (
      select (doc_id % 100)::varchar law_id, count(*) total_articles, count(*) filter (where metadata_source = 'fresh' and coalesce(enrichment_error, '') = '') enriched, count(*) filter (where metadata_source = 'cache') skipped_cache,
        count(*) filter (where metadata_source = 'fresh' and coalesce(enrichment_error, '') <> '') failed from merged group by all)
      left join (select law_id, count(*) n, (sum(input_tokens) * 10 + sum(output_tokens) * 40 + sum(image_pages) * 258000 + 50) // 100 / 1000000.0::double c from ledger where stage = 'click' group by law_id) using (law_id)""",
    "concepts_unknown": f"select doc_id, array_to_string(list_filter(w, lambda x: x in {_KNOWN}), '|') valid, len(list_filter(w, lambda x: x not in {_KNOWN})) unknown from (select doc_id, {_WORDS} w from documents)",
    "enrichment_cascade": r"""select doc_id::varchar article_id, left(regexp_replace(regexp_replace(coalesce(text, ''), '["<>\\]', ' ', 'g'), '^\s+|\s+$', '', 'g'), 100) topic, 'completed' enrichment_status, 'primary' enrichment_model, '' enrichment_error from documents""",
    "assembly_report": ("""select a.law_id, i total_articles_in, o total_articles_out, i - o duplicates_removed, f repealed_flagged, coalesce(n, 0) total_chunks_in, coalesce(n, 0) total_chunks_out, 10::bigint repealed_articles, true is_current_version
      from (select law_id, count(*) i from articles group by law_id) a join (select law_id, count(*) o, count(*) filter (where newly) f from assembled group by law_id) using (law_id) left join (select law_id, count(*) n from chunks group by law_id) using (law_id)""", _ARTICLE_CHUNKS),
    "release_metadata": (f"""select l.law_id, 'قانون ' || l.law_id law_name_ar, length(l.law_id)::varchar law_number, 2000::bigint "year", '2024-01-01T00:00:00+00:00' exported_at, '1.0' schema_version, total_articles, coalesce(total_chunks, 0) total_chunks,
      {_MEAN.format('total_article_words', 'total_articles')} avg_words_per_article, other_articles, by_m1, 'chunks.jsonl' chunks_jsonl from laws l join (select law_id, count(*) total_articles, sum(word_count)::bigint total_article_words from assembled group by law_id) using (law_id)
      left join (select law_id, count(*) total_chunks from chunks group by law_id) using (law_id)
      join (select law_id, count(*) filter (where coalesce(article_category, 'أخرى') = 'أخرى') other_articles, count(*) filter (where enrichment_model = 'm1') by_m1 from enriched group by law_id) using (law_id)""", _ARTICLE_CHUNKS),
    "cost_ledger": """select scope, name, total_calls, total_input_tokens, total_output_tokens, total_image_pages, cost_usd, coalesce(failures, 0) failures, case when scope = 'total' then (select count(*) from events where event_id % 97 = 0) else 0 end rotations from (
      select case grouping(stage, api_key_suffix) when 1 then 'stage' when 2 then 'key' else 'total' end scope, coalesce(stage, api_key_suffix, '') name, count(*) total_calls, sum(input_tokens)::bigint total_input_tokens, sum(output_tokens)::bigint total_output_tokens,
        sum(image_pages)::bigint total_image_pages, (sum(input_tokens) * 10 + sum(output_tokens) * 40 + sum(image_pages) * 258000 + 50) // 100 / 1000000.0::double cost_usd from ledger group by grouping sets ((stage), (api_key_suffix), ()))
      left join (select case grouping(k) when 0 then 'key' else 'total' end scope, coalesce(k, '') name, count(*) failures from (select '****' || right('key' || (user_id % 4), 3) k from events where event_id % 13 = 0) group by grouping sets ((k), ())) using (scope, name)""",
}
_BACK = "select article_id, law_id, article_number, article_number_raw, article_type, md5(text) text_md5, is_repealed, marker_kind, word_count, char_count from articles"
_SELECTS |= {
    "articles_from_lines": _BACK,
    "articles_from_arrays": _BACK,
    "review_csv_read": """select article_id, doc_id, md5(' "a", ' || text || ' ') text_md5 from articles""",
    "texts_read": "select law_id, md5(raw_text) text_md5 from corpus_raw",
    "cached_texts": "select law_id, case when doc_id % 4 = 0 then md5(raw_text) end text_md5, true read_if_forced from corpus_raw",
    "clean_preferred_texts": "select law_id, md5(case when doc_id % 3 = 0 or doc_id % 5 = 1 then 'c' || raw_text else raw_text end) text_md5 from corpus_raw",
    "recognised_pages": f"""select page_id::varchar as name, md5(array_to_string(list_transform(range(0, n), lambda k: case when k = 0 then '' when k % {vocab.OCR_PAGES} = 0 then chr(10) || chr(10) else chr(10) end || page_id || ' ' || (k + 1)), '')) text_md5
      from (select page_id, length(html) // 300 n from pages) where n > 0""",
    "review_manifest": (f"""select law_id, total_articles, issuance_articles, main_articles, 'chunks.csv' chunks_file, '["approved","needs_edit","rejected"]' states, 'keywords' second_check from ({_SELECTS["review_stats"][0]})""", *_SELECTS["review_stats"][1:]),
    "confidence_reports_read": "select law_id, case when doc_id % 10 <> 0 then (doc_id % 100) / 100.0::double end confidence_score from registry",
    "registry_read": """select law_id, case when doc_id % 6 <> 0 then expected_article_count else 0 end expected_article_count, array_to_string(repealed_articles, ',') repealed, expected_chapter_headings, txt_filename, pdf_filename,
      case when excluding then 1 else 0 end::bigint exclusions from registry""",
    "stale_stages": """select law_id, stage from (select law_id, least(case when doc_id % 50 = 1 or doc_id % 40 = 3 then 0 end, case when doc_id % 30 = 7 then 2 end, case when doc_id % 25 = 9 then 3 end) since from registry)
      join (select unnest(['extract', 'clean', 'confidence', 'split', 'split_check', 'enrich', 'chunk']) stage, unnest(range(7)) k) on k >= since""",
    "current_versions": f"""select v.law_id, v.version_no, version_id, valid_from::varchar valid_from, valid_to::varchar valid_to, valid_to is null is_current, n_articles, n_unchanged, n_amended, n_articles - n_unchanged - n_amended n_added,
      coalesce(lag(n_articles) over (partition by v.law_id order by v.version_no), 0) - n_unchanged - n_amended n_removed
      from ({_VERSIONS}) v join (select a.version_id, count(*) n_articles, count(*) filter (where b.line = a.line) n_unchanged, count(*) filter (where b.line <> a.line) n_amended
      from ({_LINES}) a left join ({_LINES}) b on a.law_id = b.law_id and a.version_no = b.version_no + 1 and a.number = b.number group by a.version_id) using (version_id)""",
    "articles_as_of": f"""select ask_id, e.law_id, "at"::varchar "at", version_no, version_id, len(string_split(d.text, chr(10)))::bigint n_articles
      from (select event_id ask_id, printf('L%05d', user_id % 300) law_id, date '2000-01-01' + (event_id * 31 % 1100 - 50)::int "at" from events) e
      left join ({_VERSIONS}) v on e.law_id = v.law_id and valid_from <= "at" and (valid_to is null or valid_to > "at") left join documents d on d.doc_id = version_id""",
    "upsert_generations": _SELECTS["upsert_merge"],
}
ORACLES: dict[str, str] = {name: _sql(*(s if isinstance(s, tuple) else (s,))) for name, s in _SELECTS.items()}

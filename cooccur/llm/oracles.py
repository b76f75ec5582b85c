"""The queries whose results SQL can express, in DuckDB's SQL over the same tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _alnum_words(text: str) -> str:
    folded = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return rf"regexp_extract_all({folded}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


#: Every window of every item is looked for at every place of every document.
DECONTAMINATE = f"""
with item as (select item_id, {_alnum_words("text")} w from benchmark),
windows as (
    select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') span
    from (select item_id, w, least(13, len(w)) n from item where len(w) > 0), lateral (select unnest(range(1, len(w) - n + 2)) i)),
doc as (select doc_id, {_alnum_words("text")} w from documents),
place as (select doc_id, w, unnest(range(1, len(w) + 1)) i from doc),
grams as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') span from place, (select distinct n from windows) where i + n - 1 <= len(w)),
hits as (select g.doc_id, g.i, g.n, x.item_id from grams g join windows x on g.n = x.n and g.span = x.span),
inside as (select doc_id, count(distinct spot) n_hit from (select doc_id, unnest(range(i, i + n)) spot from (select distinct doc_id, i, n from hits)) group by doc_id),
named as (
    select doc_id, count(*) n_items, string_agg(id, ',' order by id) ids
    from (select distinct doc_id, cast(item_id as varchar) id from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from doc left join inside using (doc_id) left join named using (doc_id)"""

#: Each rule as a condition; the order of the cascade has no influence on the verdict.
RULE_CASCADE = r"""
with doc as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
gram as (select doc_id, i, w[i:i + 2] g from (select doc_id, w, unnest(range(1, len(w) - 1)) i from doc)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) n from gram) where n > 1),
repeated as (select doc_id, count(distinct spot) n from (select doc_id, unnest([i, i + 1, i + 2]) spot from again) group by doc_id),
line as (select doc_id, unnest(string_split(t, chr(10))) l from doc),
lines as (select doc_id, count(*) n, count(*) - count(distinct l) dup from line where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id),
common as (select doc_id, max(n) n from (select doc_id, count(*) n from (select doc_id, unnest(w) x from doc) group by doc_id, x) group by doc_id),
counted as (
    select doc_id, len(w) n_words, length(array_to_string(w, '')) word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols,
        coalesce(lines.dup, 0) n_dup_lines, coalesce(repeated.n, 0) n_repeat_words, coalesce(lines.n, 0) n_lines, coalesce(common.n, 0) commonest,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) capitals, length(regexp_replace(t, '[^A-Za-z\x{80}-\x{10FFFF}]', '', 'g')) letters,
        len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) worded
    from doc left join lines using (doc_id) left join repeated using (doc_id) left join common using (doc_id)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from counted)
select doc_id, cast(n_words as bigint) n_words, cast(word_chars as bigint) word_chars, cast(n_symbols as bigint) n_symbols,
    cast(n_dup_lines as bigint) n_dup_lines, cast(n_repeat_words as bigint) n_repeat_words, base_failed,
    not (base_failed or n_symbols > n_words or 2 * capitals > letters or 2 * n_dup_lines > n_lines or word_chars < 2 * n_words
         or word_chars > 40 * n_words or 2 * worded < n_words or 3 * commonest > n_words) kept
from judged"""

#: All phrases of all pieces are counted, all cuts are priced, and all parts of longer phrases are looked up.
PHRASES = rf"""
with doc as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') t from documents),
piece as (select lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') w from doc),
total as (select lang, cast(sum(len(w)) as bigint) n from piece group by lang),
place as (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from piece, (select unnest([1, 2, 3, 4]) k) where len(w) >= k),
found as (select lang, k, array_to_string(w[i:i + k - 1], ' ') phrase, count(*) f from place group by all having count(*) >= 30),
split as (select *, string_split(phrase, ' ') w from found where k > 1),
cut as (
    select s.lang, s.k, s.phrase, s.f a, j, x.f l, y.f r, cast(floor((cast(2000000 as hugeint) * s.f) // (x.f + y.f)) as bigint) score
    from (select *, unnest(range(1, k)) j from split) s
    join found x on x.lang = s.lang and x.phrase = array_to_string(s.w[1:j], ' ')
    join found y on y.lang = s.lang and y.phrase = array_to_string(s.w[j + 1:], ' ')),
priced as (select * from cut qualify row_number() over (partition by lang, phrase order by score, j) = 1),
part as (
    select lang, f, array_to_string(w[i:i + j - 1], ' ') phrase
    from (select *, unnest(range(1, k - j + 2)) i from (select *, unnest(range(2, k)) j from split))),
most as (select lang, phrase, max(f) f from part group by all),
ranked as (
    select p.*, row_number() over (partition by p.lang order by score desc, a desc, p.phrase) place
    from priced p left join most m on m.lang = p.lang and m.phrase = p.phrase
    where m.f is null or 100 * cast(m.f as hugeint) < 80 * cast(a as hugeint))
select lang, place "rank", phrase, a, l, r, n, score from ranked join total using (lang) where place <= 2000"""

#: Every asked vector with every other one.
TOP_MATCHES = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) ints from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.ints, c.ints) as bigint) score
    from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) place from scored)
select query_id, cast(place as integer) "rank", vec_id, score from ranked where place <= 20"""

ORACLES = {"op4_decontaminate": DECONTAMINATE, "op8_rule_cascade": RULE_CASCADE, "op11_phrases": PHRASES,
           "op12_top_matches": TOP_MATCHES}

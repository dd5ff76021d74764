"""DuckDB SQL for the queries that SQL can express (tables are pre-registered views)."""

from __future__ import annotations

from zonekit.llm.quality import BOILERPLATE

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _stands(phrase: str) -> str:
    """The phrase as whole words of a line that has at most four words for each of its own."""
    left, right = (r"(^|[^a-z0-9\x{80}-\x{10ffff}])" if c.isascii() and c.isalnum() else "" for c in (phrase[0], phrase[-1]))
    return f"(n <= {4 * len(phrase.split())} and regexp_matches(lower(line), '{left}{phrase}{right.replace('^|', '$|', 1)}'))"


_BOILER = " or ".join(_stands(phrase) for phrase in BOILERPLATE)

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": r"""
        select doc_id, min(doc_id) over (partition by t) keep_id, count(*) over (partition by t) group_size,
               doc_id = min(doc_id) over (partition by t) kept, sha256(t) text_sha256
        from (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t from documents)""",
    "op6_warc_normaliser": r"""
        with p as (select page_id, coalesce(html, '') h from pages),
        g as (select *, max(page_id) over (partition by h) top, strlen(h) n from p)
        select page_id, n payload_bytes, sha1(h) payload_digest,
               case when n >= 1000 and page_id < top then 'revisit' else 'response' end record_type,
               case when n >= 1000 and page_id < top then top end refers_to
        from g""",
    "op5_jaccard_join": f"""
        with recursive w as (select doc_id, {_WORDS} w from documents),
        s as (select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])
                                                  when len(w) > 0 then [w] else [] end) g from w),
        n as (select doc_id, count(*) n from s group by all),
        p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b using (g) where a.doc_id <> b.doc_id group by all),
        l as (select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where c >= 0.8 * (x.n + y.n - c) - 1e-9),
        r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a)
        select w.doc_id, least(w.doc_id, coalesce((select min(b) from r where r.a = w.doc_id), w.doc_id)) class_id,
               (select count(*) from l where l.a = w.doc_id) n_links,
               (select count(distinct o.w) from l join w o on o.doc_id = l.b where l.a = w.doc_id and o.w <> w.w) n_text_links
        from w""",
    "op7_weighted_mix": f"""
        with d as (select doc_id, source, cast(len({_WORDS}) as bigint) size from documents),
        s as (select source, cast(sum(size) as bigint) source_size, row_number() over (order by source nulls last) - 1 rank from d group by source),
        t as (select *, [5.0, 2.0, 1.0][1 + rank % 3]::double w, (2 * source_size)::double cap from s),
        o as (select *, coalesce(sum(cap) over before, 0) caps, coalesce(sum(w) over before, 0) ws,
                     1.5::double * sum(source_size) over () total, sum(w) over () all_w
              from t window before as (order by cap / w, rank rows between unbounded preceding and 1 preceding)),
        f as (select *, (total - caps) / (all_w - ws) lam from o),
        rate as (select coalesce(first(lam order by cap / w, rank) filter (w * lam < cap), max(lam)) lam from f),
        g as (select source, source_size, least(w * rate.lam, cap) target from t, rate),
        q as (select d.*, source_size, target, rank sid, md5('17:' || doc_id) h,
                     coalesce(sum(size) over (partition by d.source order by md5('17:' || doc_id), doc_id, size
                                              rows between unbounded preceding and 1 preceding), 0) ahead
              from d join (select g.*, t.rank from g join t on g.source is not distinct from t.source) g on d.source is not distinct from g.source),
        o2 as (select *, ahead + pass * source_size given,
                      case when target = 0 then 0 else (ahead + pass * source_size + size)::double / target end finish
               from q, (select unnest([0, 1]) pass)),
        m as (select *, coalesce(sum(size) over (order by finish, sid, pass, h, doc_id, size
                                                 rows between unbounded preceding and 1 preceding), 0) before from o2),
        e as (select min(finish) f from m where before + size >= (select 1.5::double * sum(size) from d))
        select doc_id, size, source_size, target,
               cast(sum(case when finish <= f then size else greatest(least(floor(target * f) - given, size), 0) end) as bigint) taken
        from m, e group by all""",
    "op10_quality_rules": rf"""
        with d as (select doc_id, source, coalesce(text, '') t, {_WORDS} w, string_split(coalesce(text, ''), chr(10)) ls from documents),
        li as (select doc_id, source, unnest(ls) line, unnest(range(len(ls))) i from d),
        lc as (select *, lag(line) over o before, lead(line) over o after from li window o as (partition by doc_id order by i)),
        ld as (select source, line, arg_min(struct_pack(b := before, a := after), i) context from lc
               where len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) between 1 and 12 group by doc_id, source, line),
        co as (select k.source, line from (select source, line, count(*) n, count(distinct context) c from ld group by all) k
               join (select source, count(*) docs from d group by all) s on k.source is not distinct from s.source
               where c >= 10 and n >= 0.05 * docs),
        lj as (select li.*, co.line is not null common from li left join co on li.line = co.line and li.source is not distinct from co.source),
        lw as (select *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) n,
                      length(regexp_replace(line, '[^|»›•·]', '', 'g')) marks,
                      length(regexp_replace(line, '[^!-/:-@\[-`{{-~]', '', 'g')) punct from lj),
        lb as (select *, n > 0 and ((punct > 0.25 * length(line) or not regexp_matches(line, '[A-Za-z0-9]|[^\x00-\x7F]'))
                                    or (marks >= 3 and 2 * marks >= n - marks) or common or {_BOILER}) bad,
                      n > 0 and row_number() over (partition by doc_id, line order by i) > 1 dup from lw),
        la as (select doc_id, count(*) n_lines, count(*) filter (bad) n_bad_lines, count(*) filter (dup) n_dup_lines,
                      coalesce(sum(n) filter (bad), 0) lost from lb group by doc_id),
        g as (select doc_id, unnest(range(1, len(w) - 6)) i, w from d where len(w) >= 8),
        r as (select doc_id, i, count(*) over (partition by doc_id, w[i:i + 7]) c from g),
        c as (select doc_id, count(distinct k) n from (select doc_id, unnest(range(i, i + 8)) k from r where c > 1) group by doc_id),
        a as (select doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
                     cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols, n_dup_lines,
                     cast(coalesce(c.n, 0) as bigint) n_repeat_words, n_lines, n_bad_lines, lost
              from d join la using (doc_id) left join c using (doc_id))
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed,
               not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and lost <= 0.5 * n_words kept,
               n_lines, n_bad_lines, cast(n_words - lost as bigint) words_left
        from a""",
    "op12_prefix_trie": r"""
        with o as (select conv_id c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                          order by turn nulls first, coalesce(role, ''), coalesce(text, '')) w
                   from conversations where conv_id is not null group by 1),
        s as (select *, flatten(list_transform(range(len(c::varchar)), lambda i: [ascii(cast(c as varchar)[i + 1]), -1, -1, -1, -1, -1, -1, -1, -1])) b from o),
        h as (select *, xor(4294967295::bigint, list_reduce(list_concat([4294967295::bigint], b),
                     lambda a, x: case when x >= 0 then xor(a, x::bigint) else xor(a >> 1, (a & 1) * 3988292384) end)) % 6 h from s),
        f as (select h.c, list_concat(coalesce(p.w[1:h.h], []), h.w[h.h + 1:]) w from h left join o p on p.c = h.c - h.c % 100),
        x as (select c, w, unnest(range(len(w) + 1)) d from f),
        n as (select w[1:d] p, d, min(c) conv_id, count(*) n_convs,
                     sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (d = len(w)), '')) ends_sha256
              from x group by all),
        k as (select p[1:d - 1] p, count(*) n from n where d > 0 group by all),
        m as (select n.*, coalesce(k.n, 0) n_children, case when d = 0 then 0 else (n_convs - 1) * length(p[d].t) end saved
              from n left join k using (p)),
        u as (select p, n_children, saved, unnest(range(d + 1)) i from m),
        a as (select p[1:i] p, count(*) filter (n_children = 0) n_leaves, cast(sum(saved) as bigint) saved_tokens from u group by all)
        select m.conv_id, m.d depth, q.conv_id parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
        from m join a using (p) left join n q on m.d > 0 and q.p = m.p[1:m.d - 1]""",
}

"""SQL twins of the queries in `queries`, where SQL can express the whole result."""

from __future__ import annotations



def _manifest_sql(levels: int = 6, source_levels: int = 4) -> str:
    """A tree of at most 16 ** `levels` leaves per source and 16 ** `source_levels` sources."""
    upper = "".join(chr(c) for c in range(65, 91))
    field = lambda x: f"coalesce(strlen({x}::varchar) || ':' || {x}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    parts = [
        f"""bits as (
            select *, xor(4294967295, list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::ubigint)),
                lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i::ubigint)),
                    lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384::ubigint) else x // 2 end))) as crc
            from documents
        ), n0 as (
            select doc_id, source, {leaf("text")} as leaf,
                   case when crc % 5 = 0 then {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} else {leaf("text")} end as cur
            from bits
        ), d0 as (
            select row_number() over () as k, *, leaf as digest, '' as proof, dense_rank() over (order by source nulls first) - 1 as tree,
                   row_number() over (partition by source order by doc_id nulls first, leaf, cur) - 1 as p, count(*) over (partition by source) as n
            from n0
        ), t0 as (select tree, p, n, digest from d0)"""
    ]

    def climb(t: str, d: str, tree: str, n: int) -> None:
        for i in range(n):
            parts.append(f"""k_{t}{i} as (
                select {tree}, p // 16 as p, any_value(n) as n, list(digest order by p) as kids from {t}{i} group by {tree}, p // 16
            ), {t}{i + 1} as (
                select {tree}, p, (n + 15) // 16 as n, case when n = 1 then kids[1] else sha256(array_to_string(kids, '')) end as digest from k_{t}{i}
            ), {d}{i + 1} as (
                select d.* replace (
                    case when x.n = 1 then cur else sha256(array_to_string(list_transform(kids, lambda v, j: case when j = d.p % 16 + 1 then cur else v end), '')) end as cur,
                    proof || array_to_string(list_filter(kids, lambda v, j: j <> d.p % 16 + 1), '') as proof, d.p // 16 as p)
                from {d}{i} d join k_{t}{i} x on x.{tree} = d.{tree} and x.p = d.p // 16
            )""")

    climb("t", "d", "tree", levels)
    parts.append(f"""s0 as (select 0 as one, tree as p, (select count(*) from t{levels}) as n, digest from t{levels}
        ), e0 as (select d.* replace (d.tree as p), 0 as one, t.digest as subroot from d{levels} d join t{levels} t using (tree))""")
    climb("s", "e", "one", source_levels)
    return "with " + ", ".join(parts) + f"""
        select doc_id, leaf, subroot, digest_s as root, sha256(proof) as proof_sha256, cur as folded_root, cur = digest_s as verified
        from e{source_levels}, (select digest as digest_s from s{source_levels})"""


ORACLES: dict[str, str] = {
    "op2_substring_dedup": r"""
        with w as (
            select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as words
            from documents
        ), s as (
            select doc_id, i, array_to_string(words[i : i + 12], ' ') as seq
            from w, unnest(range(1, len(words) - 11)) as u(i)
        ), f as (
            select seq, min(doc_id) as first_id from s group by seq having count(distinct doc_id) > 1
        ), c as (
            select distinct doc_id, i + k as p
            from s join f using (seq), unnest(range(13)) as o(k) where doc_id > first_id
        ), g as (
            select doc_id, list(p) as gone from c group by doc_id
        )
        select doc_id, len(words)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
               sha256(array_to_string(list_filter(words, lambda x, i: not list_contains(coalesce(gone, []), i)), ' ')) as kept_sha256
        from w left join g using (doc_id)
    """,
    "op4_jaccard_join": r"""
        with recursive w as (
            select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as words
            from documents
        ), s as (
            select distinct doc_id, array_to_string(words[i : i + 4], ' ') as shingle
            from w, unnest(range(1, greatest(len(words) - 3, 2))) as u(i) where len(words) > 0
        ), n as (
            select doc_id, count(*) as n from s group by doc_id
        ), p as (
            select a.doc_id as a, b.doc_id as b, count(*) as c
            from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
        ), l as (
            select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where c / (x.n + y.n - c) >= 0.8
        ), r(a, b) as (
            select doc_id, doc_id from documents union select r.a, l.b from r join l on l.a = r.b
        )
        select a as doc_id, min(b) as class_id, (select count(*) from l where l.a = r.a) as n_links
        from r group by r.a
    """,
    "op11_collocations": r"""
        with d as (
            select coalesce(lang, 'und') as lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) as piece
            from documents
        ), p as (
            select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as w from d
        ), g as (
            select lang, k, w[i : i + k - 1] as g from p, unnest(range(1, 4)) as s(k), unnest(range(1, len(w) - k + 2)) as u(i)
        ), f as (
            select lang, k, g, count(*) as a from g group by all
        ), n as (
            select lang, sum(a)::bigint as n from f where k = 1 group by lang
        ), c as (
            select * from f where k > 1 and a >= 10
        ), x as (
            select c.lang, c.k, c.g, c.a, b.k as cut, b.a as l, e.a as r, ((1000000::hugeint * c.a * c.a) // (b.a::hugeint * e.a))::bigint as score
            from c join f b on b.lang = c.lang and b.k < c.k and b.g = c.g[1 : b.k]
            join f e on e.lang = c.lang and e.k = c.k - b.k and e.g = c.g[b.k + 1 :]
        ), y as (
            select * from x qualify row_number() over (partition by lang, g order by score, cut) = 1
        ), z as (
            select * from y where not exists (
                select 1 from c where c.lang = y.lang and c.k > y.k and (c.g[1:2] = y.g or c.g[2:3] = y.g) and 100 * c.a >= 50 * y.a)
        )
        select lang, rank, phrase, a, l, r, n, score
        from (select *, array_to_string(g, ' ') as phrase, row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank from z)
        join n using (lang) where rank <= 2000
    """,
    "op12_topk_search": r"""
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.w, c.w), lambda p: coalesce(p[1] * p[2], 0)))::bigint as score
            from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
        )
        select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank, vec_id, score
        from s qualify rank <= 5
    """,
    "op9_chat_formatting": r"""
        with t as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '\### Assistant: </turn> ok'
            union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), e as (
            select *, replace(replace(replace(text, '\', '\b'), '</turn>', '\t'), '### ', '\h') as body,
                   replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\t'), '### ', '\h'), ':', '\c') as head
            from t
        ), g as (
            select conv_id, count(*) as n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text) as turns,
                   coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls last, role, text), '') as loss,
                   sum(length(head) + length(body) + 14) as formatted_chars
            from e group by conv_id
        )
        select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss)::bigint as loss_chars,
               sha256(loss) as loss_sha256, formatted_chars::bigint as formatted_chars
        from g
    """,
}


def llm_oracles() -> dict[str, str]:
    return ORACLES | {"op13_merkle_manifest": _manifest_sql()}

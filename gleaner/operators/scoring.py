"""Lexicon scoring: hits with spans, maximal munch, one count per term, caps, and routing."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.config import Lexicon
from gleaner.functions.text import dedup_key, has_term, normalize_company, preprocess
from gleaner.runtime import small_batches

#: Characters that match others than their own lower case when case is ignored.
_ODD_CASE = "\u0131\u017f\u1e9e"
HIT = "struct<term:string,field:string,pts:int,s:int,e:int,capped:boolean>"


def boosted(company: Column, names: frozenset[str]) -> Column:
    """Company on the list, as it is or without its legal suffix."""
    c = F.lower(F.trim(F.coalesce(company, F.lit(""))))
    bare = F.regexp_replace(c, r",?\s+(inc|llc|corp|ltd|co\.?|corporation|company)\.?$", "")
    listed = F.array(*[F.lit(n) for n in sorted(names)]).cast("array<string>")
    return (c != "") & (F.array_contains(listed, c) | F.array_contains(listed, bare) | F.array_contains(listed, F.rtrim(bare, F.lit("."))))


def with_boost(raw: Column, titled: Column, listed: Column, lexicon: Lexicon) -> Column:
    """Listed companies gain where a title term hit and are capped where none did; nothing goes above the most."""
    raw = F.when(titled & listed, raw + lexicon.boost).when(listed & (raw > lexicon.vendor_cap), lexicon.vendor_cap).otherwise(raw)
    return F.least(raw, F.lit(lexicon.most))


def munched(hits: list[tuple]) -> list[tuple]:
    """``pruned`` over plain tuples, in one sweep per field."""
    out = []
    for field in ("title", "desc"):
        widest = (-1, -1)
        for h in sorted((h for h in hits if h[1] == field), key=lambda h: (h[3], -h[4])):
            span = (h[3], h[4])
            if h[4] > widest[1] or span == widest:
                out.append(h)
                widest = span
    return out


def best_of(hits: list[tuple]) -> list[tuple]:
    """``one_per_term`` over plain tuples."""
    best: dict[str, tuple] = {}
    for h in sorted(hits, key=lambda h: (h[1] != "title", h[3], -h[4], h[0])):
        key = re.sub("[^a-z0-9]", "", h[0].lower())
        if key not in best or (-h[2], h[1] != "title") < (-best[key][2], best[key][1] != "title"):
            best[key] = h
    return list(best.values())


def keyword_hits(lexicon: Lexicon):
    """Arrow UDF (title, description, company key) -> the best hit of each term, gates applied."""

    def compiled(terms):
        return [(t, re.compile(rf"\b{re.escape(t)}\b", re.I)) for t in terms]

    def searcher(terms):
        """text -> {term: [(start, end)]} of all whole-word places, by one pass over the text for all terms."""
        import ahocorasick

        plain = {t.lower(): t for t in terms}
        slow = compiled(terms)
        if not plain or len(plain) < len(terms):
            return lambda text: {t: [m.span() for m in p.finditer(text)] for t, p in slow}
        automaton = ahocorasick.Automaton()
        for low, t in plain.items():
            automaton.add_word(low, (t, len(low)))
        automaton.make_automaton()
        word = lambda c: c.isalnum() or c == "_"

        def search(text: str) -> dict[str, list[tuple[int, int]]]:
            low = text.lower()
            if len(low) != len(text) or any(c in low for c in _ODD_CASE):
                return {t: [m.span() for m in p.finditer(text)] for t, p in slow}
            places: dict[str, list[tuple[int, int]]] = {}
            for last, (t, size) in automaton.iter(low):
                end = last + 1
                start = end - size
                before, after = start > 0 and word(low[start - 1]), end < len(low) and word(low[end])
                if before == word(low[start]) or after == word(low[last]):
                    continue
                own = places.setdefault(t, [])
                if not own or own[-1][1] <= start:
                    own.append((start, end))
            return places

        return search

    @F.pandas_udf(f"array<{HIT}>")
    def hits(titles: pd.Series, bodies: pd.Series, companies: pd.Series) -> pd.Series:
        in_title, in_body = searcher(lexicon.title), searcher(lexicon.description)
        gates = {t.lower(): g for t, g in lexicon.gates.items()}
        co = {t: compiled(g.coterms) for t, g in gates.items()}
        veto = {t: compiled(g.vetoes) for t, g in gates.items()}
        signals = compiled(lexicon.cosignals)

        def points(term: str, text: str, span: tuple[int, int], body: str, base: int) -> int:
            key = term.lower()
            if term in lexicon.cosignal_terms and key not in gates:
                return base if any(p.search(body) for _, p in signals) else 0
            gate = gates.get(key)
            if gate is None:
                return base
            near = text if gate.window is None else text[max(0, span[0] - gate.window) : span[1] + gate.window]
            scope = body if gate.body is None else body[: gate.body]
            met = any(p.search(near) or p.search(scope) for _, p in co[key])
            if met and any(p.search(text) or p.search(body) for _, p in veto[key]):
                met = False
            return gate.points if met else gate.else_points

        def one(title, body, company):
            out = []
            for term, spans in in_title(title).items():
                for span in spans:
                    pts = points(term, title, span, body, lexicon.title[term])
                    if pts:
                        out.append((term, "title", pts, *span, False))
            for term, spans in in_body(body).items():
                if company and re.sub("[^a-z0-9]", "", term.lower()) == company and term not in lexicon.capped:
                    continue
                out += [(term, "desc", lexicon.description[term], *span, term in lexicon.capped) for span in spans]
            return best_of(munched(out))

        return pd.Series([one(t or "", b or "", c or "") for t, b, c in zip(titles, bodies, companies)])

    return hits


def native_hits(title: Column, body: Column, lexicon: Lexicon) -> Column:
    """One hit per term and field from built-in matching; exact where spans can't nest and no gate applies."""
    made = []
    for field, text, terms in (("title", title, lexicon.title), ("desc", body, lexicon.description)):
        for i, (term, pts) in enumerate(terms.items()):
            made.append(F.when(has_term(text, term), F.struct(
                F.lit(term).alias("term"), F.lit(field).alias("field"), F.lit(pts).alias("pts"), F.lit(1000 * i).alias("s"),
                F.lit(1000 * i + len(term)).alias("e"), F.lit(field == "desc" and term in lexicon.capped).alias("capped"))))
    return F.array_compact(F.array(*made)).cast(f"array<{HIT}>")


def pruned(hits: Column) -> Column:
    """Hits whose span lies strictly within another's of the same field are dropped."""
    return F.filter(hits, lambda h: ~F.exists(hits, lambda k: (
        (k["field"] == h["field"]) & (k["s"] <= h["s"]) & (h["e"] <= k["e"]) & ((k["s"] != h["s"]) | (k["e"] != h["e"])))))


def one_per_term(hits: Column) -> Column:
    """The best hit of each term across fields, titles first on ties."""
    keyed = F.transform(hits, lambda h: F.struct(
        dedup_key(h["term"]).alias("k"), (-h["pts"]).alias("p"), F.when(h["field"] == "title", 0).otherwise(1).alias("f"), h.alias("h")))
    ordered = F.array_sort(keyed)
    firsts = F.filter(ordered, lambda x, i: (i == 0) | (F.element_at(ordered, F.greatest(i, F.lit(1)))["k"] != x["k"]))
    return F.transform(firsts, lambda x: x["h"])


def total(hits: Column, cap: int) -> Column:
    """Sum of points, the capped tier counting at most ``cap``."""
    add = lambda which: F.aggregate(F.filter(hits, which), F.lit(0), lambda a, h: a + h["pts"])
    return add(lambda h: ~h["capped"]) + F.least(add(lambda h: h["capped"]), F.lit(cap))


def route(score: Column, negative: Column, titled: Column, rss: Column, lexicon: Lexicon) -> Column:
    """auto_include, llm_review, auto_reject or low_score."""
    decision = (
        F.when(negative & (score < lexicon.review_at), "auto_reject").when(negative, "llm_review")
        .when((score >= lexicon.include_at) & titled, "auto_include").when(score >= lexicon.review_at, "llm_review").otherwise("low_score")
    )
    return F.when(rss & decision.isin("auto_include", "low_score"), "llm_review").otherwise(decision)


def score_records(df: DataFrame, lexicon: Lexicon, native: bool = False) -> DataFrame:
    """df(title, description, company, source_name) with keyword_score, fit_score, keywords_matched, decision, description_snippet."""
    clean = (lambda c: F.coalesce(c, F.lit(""))) if native else preprocess
    df = df.withColumn("_t", clean(F.col("title"))).withColumn("_d", clean(F.col("description")))
    if native:
        df = df.withColumn("_hits", native_hits(F.col("_t"), F.col("_d"), lexicon))
    else:
        small_batches(df.sparkSession)
        key = F.regexp_replace(normalize_company(F.col("company")), "[^a-z0-9]", "")
        df = df.withColumn("_hits", keyword_hits(lexicon)("_t", "_d", key))
    both = F.concat_ws("\n", "_t", "_d")
    penalty = F.lit(0)
    for t, p in lexicon.reducers.items():
        counts = has_term(both, t)
        for co in lexicon.waivers.get(t.lower(), ()):
            counts = counts & ~has_term(both, co)
        penalty = penalty + F.when(counts, p).otherwise(0)
    negative = F.lit(False)
    for t in lexicon.negative:
        negative = negative | has_term(both, t)
    # The Arrow side has pruned already; the native side has one hit per term and field.
    df = df.withColumn("_kept", one_per_term(F.col("_hits")))
    titled = F.exists("_kept", lambda h: h["field"] == "title")
    listed = boosted(F.col("company"), lexicon.boost_companies)
    raw = with_boost(total(F.col("_kept"), lexicon.cap) + penalty, titled, listed, lexicon)
    df = df.withColumn("_raw", raw).withColumn("_neg", negative).withColumn("_titled", titled)
    rss = F.coalesce(F.col("source_name") == "google_alerts", F.lit(False))
    decision = route(F.col("_raw"), F.col("_neg"), F.col("_titled"), rss, lexicon)
    score = F.when(F.col("_neg") & (F.col("_raw") < lexicon.review_at), -100).otherwise(F.col("_raw"))
    return df.withColumns({
        "decision": decision, "keyword_score": score, "fit_score": F.greatest(score, F.lit(0)),
        "keywords_matched": F.array_join(F.array_distinct(F.transform("_kept", lambda h: h["term"])), ", "),
        "description_snippet": F.substring("_d", 1, 300),
    }).drop("_t", "_d", "_hits", "_kept", "_raw", "_neg", "_titled")

"""The queries in SQL, written apart from the engine, for a check by another system."""

from __future__ import annotations

from factloom.functions.suffixes import list_path
from factloom.functions.tables import LABEL_BOILERPLATE, LABEL_SCORES, LABELS, TRACKING_KEYS

P = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def part(u: str, i: int) -> str:
    return f"regexp_extract({u}, '{P}', {i})"


def host(u: str) -> str:
    return rf"regexp_replace(lower(regexp_replace(regexp_replace({part(u, 2)}, '^.*@', ''), ':[0-9]*$', '')), '^www\.', '')"


def domain(u: str) -> str:
    """Registered domains of the review fixture, whose hosts have four endings only. The list itself is read by DOMAINS."""
    return rf"regexp_extract({host(u)}, '([^.]+\.(?:gov\.br|com|net|org))$', 1)"


def query(u: str) -> str:
    drop = ", ".join(map(q, TRACKING_KEYS))
    code = lambda x: f"replace(url_encode(url_decode(replace({x}, '+', ' '))), '%20', '+')"
    kept = f"list_sort(list_filter(string_split({part(u, 4)}, '&'), lambda x: x <> '' AND split_part(x, '=', 1) NOT IN ({drop})))"
    return f"array_to_string(list_transform({kept}, lambda x: {code("split_part(x, '=', 1)")} || '=' || {code("regexp_replace(x, '^[^=]*=?', '')")}), '&')"


def canonical(u: str) -> str:
    path = f"'/' || array_to_string(list_filter(string_split({part(u, 3)}, '/'), lambda x: x NOT IN ('', '.')), '/')"
    tail = f"CASE WHEN {query(u)} <> '' OR {part(u, 5)} <> '' THEN '?' || {query(u)} ELSE '' END || CASE WHEN {part(u, 5)} <> '' THEN '#' || {part(u, 5)} ELSE '' END"
    return f"regexp_replace(lower({part(u, 1)}) || '://' || lower({part(u, 2)}) || {path} || {tail}, '[?#/ ]+$', '')"


def _label() -> str:
    text = r"lower(regexp_replace(alternate_name, '^\s+|\s+$', '', 'g'))"
    for cut in LABEL_BOILERPLATE:
        text = f"replace({text}, {q(cut)}, '')"
    return text


def _case(pairs, of: str, end: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN starts_with({of}, {q(k)}) THEN {q(v)}" for k, v in pairs) + f" ELSE {end} END"


CR = r"""
pg AS (
    SELECT page_id, html, CASE WHEN page_id % 11 = 0 THEN regexp_replace(url, '\.example\.(com|net|org)', '.site' || CAST(page_id % 7 AS VARCHAR) || '.gov.br')
                               ELSE replace(url, '.example.', '.site' || CAST(page_id % 7 AS VARCHAR) || '.') END AS url FROM pages),
np AS (SELECT count(*) AS n FROM pages),
cr AS (
    SELECT d.doc_id AS review_id, p.url, CAST(floor(d.doc_id / n) AS BIGINT) AS k,
           regexp_extract(b.text, '^([^.\n]*)', 1) || CASE CAST(floor(d.doc_id / n) AS BIGINT) WHEN 0 THEN '' WHEN 1 THEN '!' WHEN 2 THEN ' but something entirely different' ELSE '?!' END AS claim_reviewed,
           CASE d.doc_id % 12 WHEN 0 THEN 'False' WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'mostly true, but outdated' WHEN 3 THEN 'Fact Crescendo Rating: False'
                WHEN 4 THEN 'not_verifiable' WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'no idea' WHEN 8 THEN 'Half True' WHEN 9 THEN 'This is correct - almost'
                WHEN 10 THEN 'Unsubstantiated' ELSE 'Credible statement' END AS alternate_name,
           CASE WHEN d.doc_id % 11 = 0 THEN -1 ELSE 5 END AS best, CASE WHEN d.doc_id % 11 = 0 THEN -1 ELSE 1 END AS worst, CAST(d.doc_id % 7 AS INT) AS value,
           a1.url || CASE WHEN d.doc_id % 3 = 0 THEN ', ' || a2.url ELSE '' END AS appearance,
           CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(d.doc_id % 30 AS INT) END AS date_published,
           d.source AS retrieved_by
    FROM documents d CROSS JOIN np
    JOIN pg p ON p.page_id = d.doc_id % n JOIN documents b ON b.doc_id = d.doc_id % n
    JOIN pg a1 ON a1.page_id = (d.doc_id * 7 + 1) % n JOIN pg a2 ON a2.page_id = (d.doc_id * 13 + 5) % n)"""
SCORED = f"""{CR},
simple AS (SELECT *, {_case([(k.lower(), v) for k, v in LABELS.items()], _label())} AS simplified FROM cr),
scored AS (
    SELECT *, CASE simplified {" ".join(f"WHEN {q(k)} THEN {v}e0" for k, v in LABEL_SCORES.items() if v is not None)} END AS text_score,
           CASE WHEN best = -1 AND worst = -1 THEN NULL ELSE greatest(0e0, least(1e0, CAST(value - worst AS DOUBLE) / (best - worst))) END AS number_score
    FROM simple),
lab AS (
    SELECT *, {domain("url")} AS domain,
           CASE WHEN coalesce(text_score, number_score) IS NULL THEN 'not_verifiable' WHEN coalesce(text_score, number_score) > 0.8e0 THEN 'credible'
                WHEN coalesce(text_score, number_score) > 0.6e0 THEN 'mostly_credible' WHEN coalesce(text_score, number_score) > 0.4e0 THEN 'uncertain' ELSE 'not_credible' END AS label
    FROM scored)"""
SPLIT = """CASE WHEN contains(appearance, ',') THEN list_concat(string_split(appearance, ','), string_split(appearance, ' ')) ELSE [appearance] END"""
RAW_LINKS = f"""{SCORED},
raw AS (SELECT *, trim(unnest({SPLIT})) AS part FROM lab),
raw_links AS (SELECT DISTINCT review_id, {canonical("part")} AS link FROM raw WHERE regexp_matches(part, '^https?://') AND {domain("part")} <> domain)"""
REG = f"""reg AS (
    SELECT {domain("url")} AS domain, min(n_name) AS country FROM pg JOIN nation ON n_nationkey = page_id % 25 WHERE page_id % 7 < 4 GROUP BY 1)"""


def ward_rounds(points: str, distances: str, cut: float, rounds: int) -> str:
    """CTEs that end in ward(g, id, c): Ward's clusters c (smallest id) of points(g, id), from distances(a, b, d2) of all pairs of a
    group, both ways round. Each round joins the pairs of clusters that are nearest to each other, at a height up to the cut;
    heights are taken anew from the squares of all distances between and within the two."""
    out = [f"w0 AS (SELECT g, id, id AS c FROM {points})"]
    for k in range(rounds):
        out += [
            f"t{k} AS MATERIALIZED (SELECT x.c AS c1, y.c AS c2, sum(d2) AS t FROM {distances} JOIN w{k} x ON x.id = a JOIN w{k} y ON y.id = b GROUP BY x.c, y.c)",
            f"n{k} AS (SELECT c, count(*) AS n FROM w{k} GROUP BY c)",
            f"i{k} AS (SELECT c, n, coalesce(t, 0) / (n * n) AS i FROM n{k} LEFT JOIN t{k} ON c1 = c AND c2 = c)",
            f"h{k} AS MATERIALIZED (SELECT c1, c2, 2e0 * p.n * q.n / (p.n + q.n) * (t / (p.n * q.n) - p.i / 2 - q.i / 2) AS h FROM t{k} JOIN i{k} p ON p.c = c1 JOIN i{k} q ON q.c = c2 WHERE c1 <> c2)",
            f"m{k} AS (SELECT c1, c2, h FROM (SELECT *, row_number() OVER (PARTITION BY c1 ORDER BY h, c2) AS r FROM h{k}) WHERE r = 1)",
            f"j{k} AS (SELECT a.c1 AS c, least(a.c1, a.c2) AS c_new FROM m{k} a JOIN m{k} b ON a.c2 = b.c1 AND b.c2 = a.c1 WHERE a.h <= {cut * cut})",
            f"w{k + 1} AS MATERIALIZED (SELECT g, id, coalesce(c_new, w{k}.c) AS c FROM w{k} LEFT JOIN j{k} ON j{k}.c = w{k}.c)",
        ]
    return ",\n".join([*out, f"ward AS (SELECT * FROM w{rounds})"])


#: Clusters of a page's claims by Ward's heights; each review is a point, four of a page.
CLUSTERS = f"""{RAW_LINKS},
points AS (SELECT url AS g, review_id AS id, trim(claim_reviewed) AS t FROM cr),
distances AS MATERIALIZED (SELECT x.id AS a, y.id AS b, CAST(levenshtein(x.t, y.t) AS DOUBLE) ** 2 AS d2 FROM points x JOIN points y ON x.g = y.g AND x.id <> y.id),
{ward_rounds("points", "distances", 5, 4)},
clusters AS (SELECT g AS url, id AS review_id, c AS cluster FROM ward)"""
#: One row for each merged record and link, with the record's label and its first review.
LINKS = f"""{CLUSTERS},
placed AS (SELECT lab.*, cluster, row_number() OVER (PARTITION BY lab.url, cluster ORDER BY coalesce(CAST(date_published AS VARCHAR), '9999'), lab.review_id) AS place FROM lab JOIN clusters ON clusters.review_id = lab.review_id),
record_texts AS (SELECT cluster, string_agg(DISTINCT trim(claim_reviewed), '|' ORDER BY trim(claim_reviewed)) AS texts, string_agg(CAST(review_id AS VARCHAR), ',' ORDER BY place) AS ids FROM placed GROUP BY cluster),
verdicts AS (SELECT url, cluster, CASE WHEN count(DISTINCT label) > 1 THEN 'check_me' ELSE min(label) END AS final FROM placed GROUP BY url, cluster),
firsts AS (SELECT placed.review_id, placed.url, placed.cluster, trim(claim_reviewed) AS claim_reviewed, alternate_name, date_published, retrieved_by, domain, final AS label
           FROM placed JOIN verdicts ON verdicts.url = placed.url AND verdicts.cluster = placed.cluster WHERE place = 1),
links AS (
    SELECT DISTINCT f.*, link FROM firsts f JOIN placed p ON p.url = f.url AND p.cluster = f.cluster JOIN raw_links r ON r.review_id = p.review_id)"""


def _verdict(label: str = "label") -> str:
    return f"CASE WHEN count(DISTINCT {label}) > 1 THEN 'check_me' ELSE min({label}) END"


def _table(where: str = "") -> str:
    return f"""WITH {LINKS} SELECT link AS misinforming_url, {domain("link")} AS misinforming_domain, count(*) AS n_reviews,
        string_agg(CAST(review_id AS VARCHAR), ',' ORDER BY coalesce(CAST(date_published AS VARCHAR), '9999'), review_id) AS reviews,
        string_agg(texts, '|' ORDER BY coalesce(CAST(date_published AS VARCHAR), '9999'), review_id) AS claims FROM links JOIN record_texts t ON t.cluster = links.cluster {where} GROUP BY link"""


def counters(raw: str) -> str:
    """The job's counters, of all rows in `raw` (url, domain) and those collected again in lab, links and firsts."""
    return f"""again AS (SELECT url, domain FROM lab WHERE domain IN (SELECT domain FROM reg)),
        a AS (SELECT (SELECT count(*) FROM {raw}) + (SELECT count(*) FROM again) AS raw_reviews, (SELECT count(*) FROM again) AS recollected_reviews, (SELECT count(DISTINCT url) FROM again) AS review_urls,
                     count(DISTINCT url) AS urls_not_registered, count(DISTINCT domain) AS domains_not_registered FROM {raw} WHERE domain NOT IN (SELECT domain FROM reg)),
        b AS (SELECT count(*) AS merged_reviews, count(CASE WHEN label = 'check_me' THEN 1 END) AS not_matching_labels FROM firsts WHERE domain IN (SELECT domain FROM reg)),
        c AS (SELECT count(DISTINCT link) AS unique_appearances, count(DISTINCT CASE WHEN label = 'not_credible' THEN link END) AS links_not_credible FROM links WHERE domain IN (SELECT domain FROM reg)),
        x AS (SELECT domain, count(*) AS before FROM {raw} WHERE domain IN (SELECT domain FROM reg) GROUP BY domain),
        y AS (SELECT domain, count(*) AS after FROM again GROUP BY domain),
        e AS (SELECT string_agg(x.domain || ':' || before || ':' || coalesce(after, 0), ',' ORDER BY x.domain) AS recollection_stats FROM x LEFT JOIN y ON y.domain = x.domain),
        d AS (SELECT count(*) AS registered_domains FROM reg)
        SELECT * FROM a, b, c, d, e"""


RECOLLECTED = f"""{SCORED}, {REG},
before AS (SELECT domain, count(*) AS before FROM lab GROUP BY domain),
after AS (SELECT domain, count(*) AS after FROM lab WHERE review_id % 3 <> 0 GROUP BY domain),
recollected AS (
    SELECT domain, before, coalesce(after, 0) AS after, CAST(coalesce(after, 0) AS DOUBLE) / before AS ratio
    FROM reg JOIN before USING (domain) LEFT JOIN after USING (domain))"""

TWEETS = f"""{RAW_LINKS}, {REG}, t AS (SELECT *, review_id % 60 + 1 AS tweet_id FROM lab WHERE review_id % 2 = 0 AND domain IN (SELECT domain FROM reg))"""

#: Hosts with one of the endings of catalog.HOST_ENDS, and their domains by the suffix file itself: of the rules that match a
#: host's last k labels the longest, unless one is an exception. d holds page_id, host, domain and with_private.
ENDS = "com net co.uk gov.br kyoto.jp b.kyoto.jp kobe.jp x.kobe.jp city.kobe.jp k12.ca.us ca.us nhs.uk ck www.ck b.ck blogspot.com github.io qc.ca com.de sch.uk act.edu.au xn--p1ai 公司.cn nowhere.invalid bit.ly fb.me archive.org archive.is perma.cc s3.amazonaws.com 10.0.0.1 uk".split()
DOMAINS = rf"""
lines AS (SELECT unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS i FROM read_text('{list_path()}')),
rules AS (SELECT lower(split_part(trim(line), ' ', 1)) AS rule, i > (SELECT min(i) FROM lines WHERE contains(line, 'BEGIN PRIVATE DOMAINS')) AS private FROM lines WHERE trim(line) <> '' AND NOT starts_with(line, '//')),
ends AS (SELECT page_id, url, [{", ".join(map(q, ENDS))}][page_id % {len(ENDS)} + 1] AS e FROM pages),
hosts AS (SELECT page_id, CASE WHEN e = '10.0.0.1' THEN e ELSE lower(regexp_replace(regexp_extract(url, '^https?://([^/?#]*)', 1), 'example\.(com|net|org)$', e)) END AS host FROM ends),
labels AS (SELECT page_id, host, string_split(replace(host, 'xn--p1ai', 'рф'), '.') AS l, string_split(host, '.') AS own FROM hosts),
tails AS (SELECT page_id, k, array_to_string(l[len(l) - k + 1:], '.') AS tail, '*' || array_to_string(['']::VARCHAR[] || l[len(l) - k + 2:], '.') AS wild FROM labels, range(1, 9) AS r(k) WHERE k <= len(l)),
hits AS (SELECT page_id, private, k - CAST(starts_with(rule, '!') AS INT) AS k, starts_with(rule, '!') AS excepted FROM tails JOIN rules ON rule = tail OR rule = '!' || tail OR rule = wild),
longest AS (SELECT page_id, coalesce(max(k) FILTER (excepted AND NOT private), max(k) FILTER (NOT private), 0) AS public, coalesce(max(k) FILTER (excepted), max(k), 0) AS whole FROM hits GROUP BY page_id),
d AS (SELECT labels.page_id, host,
      CASE WHEN public BETWEEN 1 AND len(own) - 1 THEN regexp_replace(array_to_string(own[len(own) - public:], '.'), '^www\.', '') ELSE '' END AS domain,
      CASE WHEN whole BETWEEN 1 AND len(own) - 1 THEN regexp_replace(array_to_string(own[len(own) - whole:], '.'), '^www\.', '') ELSE '' END AS with_private
      FROM labels LEFT JOIN longest ON longest.page_id = labels.page_id)"""

SQL: dict[str, str] = {
    "rating_label": f"WITH {SCORED} SELECT review_id, label FROM lab",
    "rating_score_textual": f"WITH {SCORED} SELECT review_id, simplified, text_score AS score FROM lab",
    "rating_score_numeric": f"WITH {SCORED} SELECT review_id, number_score AS score FROM lab",
    "label_prefix_join": f"WITH {SCORED} SELECT review_id, simplified FROM lab",
    "url_canonical": f"SELECT page_id, {canonical('url')} AS canonical FROM pages",
    "url_strip_tracking": f"SELECT page_id, {query('url')} AS query FROM pages",
    "url_host_domain": f"SELECT page_id, {host('url')} AS domain FROM pages",
    "url_homepage_flag": f"SELECT page_id, {part('url', 3)} IN ('', '/', '/permalink.php') AS homepage FROM pages",
    "url_archive_unwrap": """SELECT page_id, CASE page_id % 5 WHEN 3 THEN 'https://archive.org/web/2022/' || replace(url, '://', ':/') WHEN 4 THEN 'https://web.archive.org/web/2022/x' || replace(url, '://', ':/') ELSE url END AS target FROM pages""",
    "tweet_ids": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id * 7919 + 1 END AS tweet_id FROM documents",
    "appearances_split": f"""WITH {CR} SELECT review_id, array_to_string(list_filter(list_transform({SPLIT}, lambda x: trim(x)), lambda x: regexp_matches(x, '^https?://')), '|') AS parts FROM cr""",
    "appearances_exploded": f"WITH {RAW_LINKS} SELECT review_id, link FROM raw_links",
    "appearances_no_self": f"WITH {RAW_LINKS} SELECT cr.review_id, count(link) AS n_links FROM cr LEFT JOIN raw_links ON cr.review_id = raw_links.review_id GROUP BY cr.review_id",
    "redirect_resolve": """WITH r AS (SELECT p.url, min(n.url) AS dest FROM pages p JOIN pages n ON n.page_id = p.page_id + 1 WHERE p.page_id % 7 = 0 GROUP BY p.url)
        SELECT page_id, coalesce(dest, pages.url) AS url FROM pages LEFT JOIN r ON pages.url = r.url""",
    "language_lookup": """WITH c AS (SELECT text, min(lang) AS language FROM documents WHERE doc_id % 2 = 0 GROUP BY text)
        SELECT doc_id, language FROM documents LEFT JOIN c ON documents.text = c.text""",
    "registry_join": f"WITH {SCORED}, {REG} SELECT review_id, lab.domain, country FROM lab JOIN reg ON lab.domain = reg.domain",
    "registry_semi": f"WITH {SCORED}, {REG} SELECT review_id, domain FROM lab WHERE domain IN (SELECT domain FROM reg)",
    "registry_anti": f"WITH {SCORED}, {REG} SELECT review_id, domain FROM lab WHERE domain NOT IN (SELECT domain FROM reg)",
    "unregistered_domains": f"WITH {SCORED}, {REG} SELECT domain, count(*) AS n_reviews, count(DISTINCT url) AS n_urls FROM lab WHERE domain NOT IN (SELECT domain FROM reg) GROUP BY domain",
    "recollection_stats": f"WITH {RECOLLECTED} SELECT * FROM recollected",
    "recollection_ratio": f"WITH {RECOLLECTED} SELECT CAST(sum(before) AS BIGINT) AS total_before, CAST(sum(after) AS BIGINT) AS total_after, round(avg(ratio), 6) AS mean_ratio FROM recollected",
    "country_distribution": f"""WITH {SCORED}, {REG}, n AS (SELECT domain, count(DISTINCT url) AS n FROM lab GROUP BY domain)
        SELECT country, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_urls FROM reg LEFT JOIN n USING (domain) GROUP BY country""",
    "reviews_by_url": f"WITH {CR} SELECT url, count(*) AS n, string_agg(lpad(CAST(review_id AS VARCHAR), 12, '0'), ',' ORDER BY review_id) AS reviews FROM cr GROUP BY url",
    "unique_urls_by_source": f"WITH {CR} SELECT retrieved_by, count(DISTINCT url) AS n_urls FROM cr GROUP BY retrieved_by",
    "claim_clusters": f"WITH {CLUSTERS} SELECT url, review_id, cluster FROM clusters",
    "different_texts": f"""WITH {LINKS}, n AS (SELECT url, count(DISTINCT cluster) AS n_clusters FROM clusters GROUP BY url HAVING count(DISTINCT cluster) > 1)
        SELECT DISTINCT c.url, c.cluster, n_clusters, texts FROM clusters c JOIN n ON n.url = c.url JOIN record_texts t ON t.cluster = c.cluster""",
    "disagreeing_records": f"""WITH {LINKS}, n AS (SELECT link FROM links GROUP BY link HAVING count(DISTINCT label) > 1)
        SELECT links.link, url, links.cluster, domain, label, texts, ids AS reviews FROM links JOIN n ON n.link = links.link JOIN record_texts t ON t.cluster = links.cluster""",
    "merged_reviews": f"""WITH {CLUSTERS},
        l AS (SELECT cluster, string_agg(DISTINCT link, '|' ORDER BY link) AS links FROM raw_links JOIN clusters ON raw_links.review_id = clusters.review_id GROUP BY cluster)
        SELECT lab.url, c.cluster, any_value(domain) AS domain, {_verdict()} AS label, count(DISTINCT trim(claim_reviewed)) AS n_texts, coalesce(any_value(links), '') AS links, count(*) AS n_reviews
        FROM lab JOIN clusters c ON lab.review_id = c.review_id LEFT JOIN l ON c.cluster = l.cluster GROUP BY lab.url, c.cluster""",
    "link_conflicts": f"WITH {LINKS} SELECT link, count(DISTINCT label) AS n_labels, count(*) AS n_reviews, {_verdict()} AS final_label FROM links GROUP BY link",
    "disagreeing_links": f"WITH {LINKS} SELECT link, count(DISTINCT label) AS n_labels, count(*) AS n_reviews, {_verdict()} AS final_label FROM links GROUP BY link HAVING count(DISTINCT label) > 1",
    "links_all": _table(),
    "links_not_credible_full": _table("WHERE label = 'not_credible'"),
    "links_not_credible": f"WITH {LINKS} SELECT DISTINCT link FROM links WHERE label = 'not_credible'",
    "multi_reviewed_links": f"WITH {LINKS} SELECT link, count(DISTINCT domain) AS n_domains, string_agg(DISTINCT domain, ',' ORDER BY domain) AS domains FROM links GROUP BY link HAVING count(DISTINCT domain) > 1",
    "wide_reviews": f"""WITH {LINKS},
        o AS (SELECT *, row_number() OVER (PARTITION BY link, domain ORDER BY review_id DESC) AS r FROM links),
        w AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY domain) - 1 AS i FROM o WHERE r = 1)
        SELECT link, count(*) AS n_domains, {", ".join(f"max(CASE WHEN i = {i} THEN {c} END) AS {name}_{i}" for i in range(3) for c, name in (("domain", "review_domain"), ("url", "review_url"), ("label", "label"), ("alternate_name", "original_label")))}
        FROM w GROUP BY link HAVING count(*) > 1""",
    "wide_reviews_rest": f"""WITH {LINKS},
        o AS (SELECT *, row_number() OVER (PARTITION BY link, domain ORDER BY review_id DESC) AS r FROM links),
        w AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY domain) - 1 AS i FROM o WHERE r = 1)
        SELECT link, i AS place, domain AS review_domain, url AS review_url, label, alternate_name AS original_label FROM w WHERE i > 2""",
    "first_review_per_link": f"""WITH {LINKS}, o AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY coalesce(CAST(date_published AS VARCHAR), '9999'), review_id) AS r FROM links)
        SELECT link, review_id, url, label FROM o WHERE r = 1""",
    "label_mapping": f"""WITH {SCORED}, o AS (SELECT *, coalesce(alternate_name, '') AS original_label FROM lab),
        d AS (SELECT original_label, string_agg(DISTINCT domain, ',' ORDER BY domain) AS domains FROM o GROUP BY original_label)
        SELECT o.original_label, label, count(*) AS n, any_value(domains) AS domains FROM o JOIN d ON o.original_label = d.original_label GROUP BY label, o.original_label""",
    "count_by_domain_label_top100": f"WITH {SCORED} SELECT domain, label, count(*) AS n FROM lab GROUP BY domain, label ORDER BY n DESC, domain, label LIMIT 100",
    "label_histogram": f"WITH {SCORED} SELECT label, count(*) AS n FROM lab GROUP BY label",
    "date_histogram": f"WITH {CR} SELECT CAST(date_published AS VARCHAR) AS day, count(*) AS n FROM cr GROUP BY 1",
    "job_stats": f"WITH {LINKS}, {REG}, {counters('lab')}",
    # reviews collected again are two of three, and only they are clustered and merged
    "job_stats_recollected": f"""WITH {LINKS.replace("(d.doc_id * 13 + 5) % n)", "(d.doc_id * 13 + 5) % n WHERE d.doc_id % 3 <> 0)")}, {REG},
        every_row AS (SELECT p.url, {domain("p.url")} AS domain FROM documents d CROSS JOIN np JOIN pg p ON p.page_id = d.doc_id % n), {counters('every_row')}""",
    "agree_by_domain": f"WITH {SCORED} SELECT domain, min(label) AS label, string_agg(DISTINCT retrieved_by, ',' ORDER BY retrieved_by) AS sources FROM lab GROUP BY domain HAVING count(DISTINCT label) = 1",
    "aggregate_agree": f"WITH {SCORED} SELECT url, min(label) AS label, string_agg(DISTINCT retrieved_by, ',' ORDER BY retrieved_by) AS sources FROM lab GROUP BY url HAVING count(DISTINCT label) = 1",
    "labels_per_author": f"WITH {SCORED} SELECT retrieved_by, count(DISTINCT label) AS n_labels FROM lab GROUP BY retrieved_by",
    "json_path_counts": "SELECT path, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS path FROM events) GROUP BY path",
    "filter_satisfy": f"""WITH {LINKS} SELECT link AS misinforming_url FROM links GROUP BY link
        HAVING count(CASE WHEN date_published >= DATE '2019-01-01' THEN 1 END) > 0 AND {part("link", 3)} NOT IN ('', '/', '/permalink.php')""",
    "filter_since_until": f"""WITH {LINKS} SELECT link AS misinforming_url FROM links GROUP BY link
        HAVING count(CASE WHEN date_published >= DATE '2024-01-15' THEN 1 END) > 0 AND count(CASE WHEN date_published <= DATE '2024-01-15' THEN 1 END) > 0 AND {part("link", 3)} NOT IN ('', '/', '/permalink.php')""",
    "snapshot_range": f"WITH {CR} SELECT DISTINCT strftime(date_published, '%Y_%m_%d') AS date FROM cr WHERE date_published BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    "topic_extract": f"""WITH {LINKS},
        o AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY coalesce(CAST(date_published AS VARCHAR), '9999'), review_id) AS r,
                     count(*) OVER (PARTITION BY link) AS n_reviews, max(coalesce(CAST(date_published AS VARCHAR), '0')) OVER (PARTITION BY link) AS last_date FROM links)
        SELECT link AS misinforming_url, {domain("link")} AS misinforming_domain, replace(claim_reviewed, chr(10), '\\n') AS claim, url AS review_url, domain AS fact_checker, label, n_reviews, last_date
        FROM o WHERE r = 1 AND last_date > '2024-01-10' AND (contains(lower(claim_reviewed || ' ' || url), 'the') OR contains(lower(claim_reviewed || ' ' || url), 'que'))""",
    "latest_100": f"WITH {CR} SELECT review_id, url, CAST(date_published AS VARCHAR) AS day FROM cr WHERE date_published <= DATE '2024-01-20' ORDER BY date_published DESC, review_id LIMIT 100",
    "latest_10_with_page": f"""WITH {CR}, l AS (SELECT * FROM cr WHERE date_published <= DATE '2024-01-20' ORDER BY date_published DESC, review_id LIMIT 100),
        t AS (SELECT url, min(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title FROM pg WHERE regexp_extract(html, '<title>([^<]*)</title>', 1) <> '' GROUP BY url)
        SELECT review_id, l.url, title FROM l JOIN t ON l.url = t.url ORDER BY date_published DESC, review_id LIMIT 10""",
    "top50_domains": f"WITH {SCORED} SELECT domain, count(*) AS n FROM lab GROUP BY domain ORDER BY n DESC, domain LIMIT 50",
    "first100_per_checker": f"""WITH {SCORED}, o AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY date_published DESC NULLS LAST, url, review_id) AS place FROM lab)
        SELECT domain, review_id, place FROM o WHERE place <= 100""",
    "dedupe_last_wins": f"WITH {CR} SELECT url, max(review_id) AS review_id FROM cr GROUP BY url",
    "cursor_sample": f"""WITH {LINKS},
        t AS (SELECT link, max(date_published) AS d FROM links GROUP BY link),
        p AS (SELECT link, d >= DATE '2024-01-20' AND {part("link", 3)} NOT IN ('', '/', '/permalink.php') AS ok, row_number() OVER (ORDER BY md5('seed' || link)) - 1 AS pos, count(*) OVER () AS n FROM t),
        f AS (SELECT link, pos, n, row_number() OVER (ORDER BY (pos - 17 % n + n) % n) AS r FROM p WHERE ok)
        SELECT a.link AS misinforming_url, {domain("a.link")} AS misinforming_domain, a.pos AS position, coalesce(b.pos, (16 + a.n) % a.n) AS next_cursor
        FROM f a LEFT JOIN f b ON b.r = 2 WHERE a.r = 1""",
    "union_sources": f"WITH {CR} SELECT review_id, url FROM cr WHERE k = 0 UNION ALL SELECT review_id, url FROM cr WHERE k < 2",
    "except_known_urls": f"WITH {CR} SELECT review_id, url FROM cr WHERE url NOT IN (SELECT url FROM cr WHERE review_id % 5 = 0)",
    "merge_precedence": f"""WITH {CR}, b AS (SELECT url, max(review_id) AS review_id FROM cr WHERE k = 1 AND review_id % 2 = 0 GROUP BY url)
        SELECT cr.url, coalesce(b.review_id, cr.review_id) AS review_id FROM cr LEFT JOIN b ON cr.url = b.url WHERE k = 0""",
    "upsert_reviews": f"""WITH {CR}, n AS (SELECT url, review_id FROM cr WHERE k = 2 AND review_id % 3 = 0)
        SELECT url, review_id FROM cr WHERE k = 0 AND url NOT IN (SELECT url FROM n) UNION ALL SELECT url, review_id FROM n""",
    "replace_source_partition": f"""WITH {CR} SELECT retrieved_by, count(*) AS n FROM (
        SELECT retrieved_by FROM cr WHERE retrieved_by <> 'src1' UNION ALL SELECT 'src1' AS retrieved_by FROM cr WHERE k = 0 AND review_id % 2 = 0) GROUP BY retrieved_by""",
    "page_title": "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages",
    "jsonld_extract": "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS claim, 'False' AS label FROM pages",
    "jsonld_graph_extract": "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS claim, 'False' AS label FROM pages",
    "jsonld_repair": "SELECT page_id, 'a \"quoted\" ' || regexp_extract(html, '<title>([^<]*)</title>', 1) AS claim, 'False' AS label FROM pages",
    "microdata_extract": "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) <> '' AS has_claim, 'False' AS label FROM pages",
    "raw_reviews": f"""WITH {CR} SELECT url, 'claim' AS claim, CASE page_id % 4 WHEN 0 THEN 'not_credible' WHEN 1 THEN 'mostly_credible' ELSE 'uncertain' END AS label,
        CASE page_id % 4 WHEN 0 THEN 'http://one.org/' || page_id || '|http://two.org/b|http://zero.org' WHEN 1 THEN 'http://one.org/' || page_id || '|http://three.org/x?#f'
             WHEN 2 THEN 'http://one.org/' || page_id || '|http://one.org/' || page_id || ',http:/two.org/q|http://two.org/q' ELSE 'http://one.org/' || page_id END AS links,
        CASE WHEN page_id % 4 < 3 THEN '2024-02-03' END AS day FROM pg""",
    "pages_to_reviews": """SELECT CASE page_id % 3 WHEN 0 THEN 'https://www.jsonld.org/' ELSE 'https://www.politifact.com/' END || page_id || '/?utm_source=feed' AS url,
        CASE page_id % 3 WHEN 0 THEN 'not_credible' ELSE 'credible' END AS label, CASE page_id % 3 WHEN 0 THEN 'http://link.org/' || page_id ELSE '' END AS links, true AS has_claim FROM pages WHERE page_id % 3 < 2""",
    "csv_reviews": f"""WITH {CR} SELECT {canonical("url")} AS url, 'claim ' || page_id AS claim_reviewed, 'org' || page_id % 9 AS author, 'http://one.org/' || page_id || '|https://two.org|https://httpnot' AS links,
        strftime(DATE '2024-01-01' + CAST(page_id % 300 AS INT), '%Y-%m-%d') AS day FROM pg""",
    "rest_items": "SELECT CAST(page_id AS VARCHAR) AS id, 'https://home.org/s' || page_id || CASE WHEN page_id % 5 = 0 THEN 'b' ELSE 'a' END AS url FROM pages",
    "registry_parse": f"WITH {CR}, d AS (SELECT {domain('url')} AS domain, max(page_id) AS n FROM pg GROUP BY 1) SELECT domain, 'n' || n AS name, 'c' || n % 25 AS country FROM d",
    "spreadsheet_rows": "SELECT page_id + 1 AS place, CAST(page_id AS VARCHAR) AS number, url AS link FROM pages",
    "topic_feed_flatten": r"""WITH o AS (SELECT page_id, i, 'http://topic.org/' || page_id % 50 AS link FROM pages, range(1, 3) AS r(i) WHERE page_id % 10 <> 9)
        SELECT link, '2024-01-0' || i AS date, 'https://debunk.org/' || page_id || '/' || i AS debunk_link, 'a\nb' AS title, 'f' || page_id % 5 AS factchecker, count(*) OVER (PARTITION BY link) AS n_of_link FROM o""",
    "days_normalised": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
    "json_leaf_counts": """WITH k AS (SELECT unnest(json_keys(props)) AS k FROM events), n AS (SELECT count(*) AS n FROM events)
        SELECT 'a.b.c.d.' || k AS path, count(*) AS n FROM k GROUP BY 1 UNION ALL SELECT 'l.u', 2 * n FROM n UNION ALL SELECT 'l', n FROM n UNION ALL SELECT 't', n FROM n""",
    "json_link_paths": """WITH n AS (SELECT count(*) AS n FROM events) SELECT 'url' AS path, n FROM n UNION ALL SELECT 'itemReviewed.appearance.url', n FROM n
        UNION ALL SELECT 'itemReviewed.appearance', n FROM n UNION ALL SELECT 'itemReviewed.author.sameAs', 2 * n FROM n""",
    "shared_facts": f"WITH {CR} SELECT url, 'https://www.sharethefacts.co/share/' || page_id AS widget FROM pg",
    "url_canonical_features": """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'http' ELSE 'https' END || '://Me@www.a' || page_id || '.org' || CASE page_id % 4 WHEN 2 THEN ':8080' ELSE '' END
        || '/a%20b/~uA/%C3%A9?e=&k=' || page_id || '&z=A+b#x%20y%23' AS canonical FROM pages""",
    "links_resolved": """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'http://to.org/' WHEN 1 THEN 'http://kept.org/' WHEN 2 THEN 'http://of.org/' ELSE 'http://plain.org/' END || page_id AS url FROM pages""",
    **{
        f"listing_{name}": f"SELECT '{base}' || page_id AS url, {title} AS title, {day} AS day, {label} AS label, {onward} AS next FROM pages"
        for name, base, title, day, label, onward in [
            ("snopes", "http://l.org/", "'T' || page_id", "'2024-02-03'", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
            ("politifact", "https://www.politifact.com/", "'T' || page_id", "'2024-02-03'", "'not_credible'", "CAST(NULL AS VARCHAR)"),
            ("factcheck_org", "http://l.org/", "'T' || page_id", "'2024-02-03'", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
            ("factcheckni", "http://l.org/", "'T' || page_id", "'2024-02-03'", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
            ("leadstories", "http://l.org/", "'T' || page_id", "'2024-02-03'", "'not_credible'", "CAST(NULL AS VARCHAR)"),
            ("istinomer", "http://l.org/", "'T' || page_id", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
            ("weeklystandard", "http://l.org/", "'T' || page_id", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "'/n'"),
            ("teyit_org", "http://l.org/", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
            ("fullfact", "https://fullfact.org/", "'T' || page_id", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
            ("euvsdisinfo", "https://euvsdisinfo.eu/", "'T' || page_id", "'2024-02-03'", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
        ]
    },
    "link_chains": """WITH RECURSIVE p AS (SELECT page_id, url, page_id % 13 AS kind, 'http://bit.ly/' || page_id || '/' AS short, 'http://t.co/' || page_id AS t FROM pages),
        e AS (
            SELECT short || i AS a, CASE WHEN i = kind THEN url ELSE short || (i + 1) END AS b FROM p, range(9) AS r(i) WHERE kind < 9 AND i <= kind
            UNION ALL SELECT short || i, short || ((i + 1) % 3) FROM p, range(3) AS r(i) WHERE kind = 9
            UNION ALL SELECT short || 0, 'https://web.archive.org/web/2022/' || t FROM p WHERE kind = 10
            UNION ALL SELECT 'https://web.archive.org/web/2022/' || t, t FROM p WHERE kind = 10
            UNION ALL SELECT t, url FROM p WHERE kind >= 10
            UNION ALL SELECT 'https://archive.ph/' || page_id, t FROM p WHERE kind = 11
            UNION ALL SELECT 'https://perma.cc/AB-' || page_id || '?type=image', t FROM p WHERE kind = 12),
        w AS (
            SELECT page_id, CASE kind WHEN 11 THEN 'https://archive.ph/' || page_id WHEN 12 THEN 'https://perma.cc/AB-' || page_id || '?type=image' ELSE short || 0 END AS cur, 0 AS n FROM p
            UNION ALL SELECT page_id, b, n + 1 FROM w JOIN e ON a = cur WHERE n < 12)
        SELECT page_id, coalesce(min(cur) FILTER (cur NOT IN (SELECT a FROM e)), min(cur) FILTER (n = 0)) AS url FROM w GROUP BY page_id""",
    "listing_until_known": """WITH m AS (SELECT floor(max(page_id) / 2) AS m FROM pages) SELECT page_id, url FROM pages, m WHERE page_id < m AND page_id % 4 <> 1""",
    "topic_recent": f"WITH {LINKS} SELECT link AS misinforming_url, max(coalesce(CAST(date_published AS VARCHAR), '0')) AS last_date FROM links GROUP BY link HAVING max(coalesce(CAST(date_published AS VARCHAR), '0')) > '2024-01-20'",
    "page_article": "SELECT page_id, nullif(trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)), '') AS title, nullif(regexp_extract(html, '<meta[^>]*name=\"description\"[^>]*content=\"([^\"]*)\"', 1), '') AS description FROM pages",
    "check_me_excluded": f"WITH {LINKS} SELECT replace(label, '_', ' ') AS label, count(*) AS n FROM firsts WHERE label <> 'check_me' GROUP BY 1",
    "recollection_percent": f"WITH {RECOLLECTED} SELECT domain, round(100 * ratio, 4) AS percent FROM recollected",
    "stale_snapshots": f"WITH {CR} SELECT DISTINCT strftime(date_published, '%Y_%m_%d') AS date FROM cr WHERE date_published IS NOT NULL AND date_published <> DATE '2024-01-20'",
    "wide_claims": f"WITH {CLUSTERS} SELECT cr.url, cluster, min(trim(claim_reviewed)) AS text FROM cr JOIN clusters ON clusters.review_id = cr.review_id GROUP BY cr.url, cluster",
    "tweet_reviews": f"""WITH {TWEETS} SELECT tweet_id, CASE WHEN count(DISTINCT label) > 1 THEN 'check_me' ELSE min(label) END AS label, count(*) AS n_reviews, tweet_id IN (SELECT conv_id FROM conversations WHERE turn = 0 AND text IS NOT NULL) AS found FROM t GROUP BY tweet_id""",
    "tweet_stats": f"""WITH {TWEETS}, g AS (SELECT tweet_id, count(*) AS n, count(DISTINCT label) AS l FROM t GROUP BY tweet_id)
        SELECT count(*) AS tweet_reviews, CAST(count(*) FILTER (tweet_id NOT IN (SELECT conv_id FROM conversations WHERE turn = 0 AND text IS NOT NULL)) AS BIGINT) AS tweets_not_found, count(*) FILTER (n > 1) AS tweets_of_several_reviews, count(*) FILTER (l > 1) AS tweets_disagreeing,
               (SELECT count(*) FROM raw_links WHERE review_id % 2 = 1 AND review_id IN (SELECT review_id FROM lab WHERE domain IN (SELECT domain FROM reg))) AS links_without_tweet,
               (SELECT count(*) FROM lab WHERE review_id % 2 = 1 AND domain IN (SELECT domain FROM reg)) AS reviews_without_tweet FROM g""",
    "tweet_labels": f"""WITH {TWEETS} SELECT label, string_agg(DISTINCT coalesce(alternate_name, ''), '|' ORDER BY coalesce(alternate_name, '')) AS original_labels FROM t GROUP BY label""",
    "embedding_pairs": "SELECT a.vec_id AS i, b.vec_id AS j FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_distance(a.embedding, b.embedding) < 1.15",
    "embedding_clusters": f"""WITH distances AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) ** 2)) AS d2
            FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
        points AS (SELECT label AS g, vec_id AS id FROM embeddings), {ward_rounds("points", "distances", 1.15, 6)}
        SELECT id AS vec_id, c AS cluster FROM ward WHERE c IN (SELECT c FROM ward GROUP BY c HAVING count(*) > 1)""",
    "events_tumbling": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "events_session": """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
        s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g),
        c AS (SELECT user_id, s, count(*) AS n FROM s GROUP BY user_id, s)
        SELECT user_id, count(*) AS n_sessions, max(n) AS longest FROM c GROUP BY user_id""",
}
if list_path():
    SQL |= {
        "url_registered_domain": f"""WITH {DOMAINS} SELECT page_id, domain, with_private, domain IN ('bit.ly', 'fb.me') AS shortener, domain IN ('archive.org', 'archive.is', 'perma.cc') AS archive FROM d""",
        "registered_domain_counts": f"""WITH {DOMAINS} SELECT domain, count(*) AS n, count(DISTINCT regexp_replace(host, '^www\\.', '')) AS hosts FROM d GROUP BY domain""",
    }

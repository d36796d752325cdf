"""The same answers in plain SQL, for DuckDB on the same tables.

Written from the definitions, not from the Spark plans: distances are taken
over all pairs, sentiment over unnested words.
"""

from __future__ import annotations

import string

from innsight.sources.places import POINTS_OF_INTEREST
from workload import views
from workload.queries import (
    CHAT_OUTPUT,
    FIXED_SIGHT_RADIUS_KM,
    PAIR_RADIUS_KM,
    POINT,
    POINT_RADIUS_KM,
    SIGHT_RADIUS_KM,
    TAG_MIN,
    WORD_MIN,
)

# Written out, so that a wrong list in the library shows.
CLEAN = {
    "Hotel_Address": "string",
    "Additional_Number_of_Scoring": "int",
    "Review_Date": "date",
    "Average_Score": "double",
    "Hotel_Name": "string",
    "Reviewer_Nationality": "string",
    "Negative_Review": "string",
    "Review_Total_Negative_Word_Counts": "int",
    "Total_Number_of_Reviews": "int",
    "Positive_Review": "string",
    "Review_Total_Positive_Word_Counts": "int",
    "Total_Number_of_Reviews_Reviewer_Has_Given": "int",
    "Reviewer_Score": "double",
    "Tags": "array<string>",
    "days_since_review": "int",
    "lat": "double",
    "lng": "double",
    "Hotel_Nationality": "string",
    "Hotel_City": "string",
}
PRESENT = """Additional_Number_of_Scoring is not null and Review_Date is not null and Average_Score is not null
  and Hotel_Name is not null and Review_Total_Negative_Word_Counts is not null and Total_Number_of_Reviews is not null
  and Review_Total_Positive_Word_Counts is not null and Total_Number_of_Reviews_Reviewer_Has_Given is not null
  and Reviewer_Score is not null and Tags is not null and days_since_review is not null
  and lat is not null and lng is not null"""

REVIEWS = """
reviews as (
  select case when s.s_suppkey % 5 = 0 then concat('Chain ', s.s_suppkey // 10) else s.s_name end as Hotel_Name,
    sn.n_name as Hotel_City, r.r_name as Hotel_Nationality,
    40e0 + sn.n_nationkey/2e0 + ((s.s_suppkey*37) % 64 - 32)/1024e0 as lat,
    5e0 + sn.n_nationkey/4e0 + ((s.s_suppkey*53) % 64 - 32)/1024e0 as lng,
    case when o.o_custkey % 9 = 4 then 'Unknown' else cn.n_name end as Reviewer_Nationality, cast(l.l_shipdate as date) as Review_Date,
    10e0 - l.l_quantity*l.l_quantity/256e0 as Reviewer_Score,
    8e0 + (s.s_suppkey % 16)/16e0 as Average_Score,
    concat('flag ', lower(l.l_returnflag), ' and status ', lower(l.l_linestatus)) as Positive_Review,
    concat('line ', l.l_linenumber, ' of order ', l.l_orderkey) as Negative_Review,
    [o.o_orderpriority, p.p_type, l.l_returnflag] as Tags
  from lineitem l join orders o on l.l_orderkey=o.o_orderkey
    join customer c on o.o_custkey=c.c_custkey join nation cn on c.c_nationkey=cn.n_nationkey
    join supplier s on l.l_suppkey=s.s_suppkey join nation sn on s.s_nationkey=sn.n_nationkey
    join region r on sn.n_regionkey=r.r_regionkey join part p on l.l_partkey=p.p_partkey
)"""

TEXTS = """
split_texts as (
  select *, strpos(text, chr(10)) as nl from documents
),
texts as (
  select doc_id as review_id, source as Hotel_Name, 'City of ' || lang as Hotel_City,
    case when doc_id % 3 = 0 then upper(lang[1]) || lower(lang[2:]) else lang end as Hotel_Nationality, '1 Text Street ' || source as Hotel_Address,
    date '2015-01-01' + cast(doc_id % 1096 as integer) as Review_Date,
    1e0 + (n_chars % 145)/16e0 as Reviewer_Score,
    doc_id % 40 + 1 as activity,
    coalesce(nullif(lower(trim(case when nl > 0 then substr(text, 1, nl - 1) else text end, ' ')), ''),
      'No positive comment') as Positive_Review,
    coalesce(nullif(lower(trim(case when nl > 0 then substr(text, nl + 1) else '' end, ' ')), ''),
      'No negative comment') as Negative_Review
  from split_texts
)"""

LEXICON = (
    "lexicon as (select * from (values "
    + ", ".join(
        f"('{word}', {valence}e0, '{views.PARTS_OF_SPEECH[word]}')"
        for word, valence in views.LEXICON.items()
    )
    + ") v(word, valence, pos))"
)

_MARKS = string.punctuation.replace("'", "''")

SCORED = f"""
{TEXTS}, {LEXICON},
hits as (
  select review_id, sum(valence) as s from (
    select review_id, trim(unnest(regexp_split_to_array(
      lower(Positive_Review || '. ' || Negative_Review), '\\s+')), '{_MARKS}') as word from texts) t
  join lexicon using (word) group by review_id
),
scored as (
  select texts.*, coalesce(s, 0e0) as total,
    coalesce(s, 0e0) / sqrt(coalesce(s, 0e0) * coalesce(s, 0e0) + 15e0) as score,
    case when month(Review_Date) in (12, 1, 2) then 'Winter' when month(Review_Date) in (3, 4, 5) then 'Spring'
      when month(Review_Date) in (6, 7, 8) then 'Summer' else 'Autumn' end as Season
  from texts left join hits using (review_id)
)"""


def _km(lat0: str, lng0: str, lat1: str, lng1: str) -> str:
    a = (
        f"(pow(sin(radians({lat1} - {lat0}) / 2), 2) + cos(radians({lat0})) * cos(radians({lat1}))"
        f" * pow(sin(radians({lng1} - {lng0}) / 2), 2))"
    )
    return f"2 * 6371e0 * asin(sqrt({a}))"


def _six(sql: str) -> str:
    return f"floor(({sql}) * 1e6 + 0.5e0) / 1e6"


_SITES = "sites as (select distinct Hotel_Name, Hotel_City, lat, lng from reviews)"
_MEANS = "means as (select Hotel_Name, avg(Reviewer_Score) as m from reviews group by all)"


def _label_counts(label: str) -> str:
    return f"""with {SCORED},
      labelled as (select *, {label} as label from scored),
      counted as (
        select Hotel_Name, min(Hotel_Address) as Hotel_Address, count(*) as Num_Reviews,
          count(*) filter (label = 'positive') as Positive_Count,
          count(*) filter (label = 'neutral') as Neutral_Count,
          count(*) filter (label = 'negative') as Negative_Count
        from labelled group by Hotel_Name),
      net as (
        select *, round_even((Positive_Count - Negative_Count) / Num_Reviews, 3) as Average_Sentiment_Score
        from counted)
      select *, 'Il sentiment medio dell''hotel ' || Hotel_Name || ' è ' ||
          case when Average_Sentiment_Score < -0.2 then 'piuttosto negativo 🥵'
               when Average_Sentiment_Score > 0.2 then 'piuttosto positivo 😄'
               else 'neutrale 😐' end as Sentiment,
        case when Average_Sentiment_Score < -0.2 then 'negativo'
             when Average_Sentiment_Score > 0.2 then 'positivo' else 'neutrale' end as band
      from net"""


_KNOWN = "select word from lexicon where pos in ('a', 'r')"
_OF_BENCHMARK = """select word from (select unnest(regexp_split_to_array(lower(text), '\\s+')) as word from benchmark) b
      where word <> '' and length(word) % 2 = 0"""


def _word_scores(kind: str, strip: bool = False, exclude: bool = False, known: str = _KNOWN) -> str:
    column = f"{kind.capitalize()}_Review"
    word = "unnest(regexp_split_to_array(" + column + ", '\\s+'))"
    if strip:
        word = f"trim({word}, '{_MARKS}')"
    where = f"where {column} not in ('No positive comment', 'No negative comment')" if exclude else ""
    return f"""select '{kind}' as type, word, {_six('avg(Reviewer_Score)')} as avg_score, count(*) as word_count
      from (select Reviewer_Score, {word} as word from texts {where}) t
      where word in ({known})
      group by word having count(*) >= {WORD_MIN}"""


def _extremes(by: str | None) -> str:
    parts = []
    group = f"partition by {by}" if by else ""
    shown = f"{by} as by_{by}, " if by else ""
    for kind, column in (("positiva", "Positive_Review"), ("negativa", "Negative_Review")):
        for direction in ("desc", "asc"):
            parts.append(
                f"""select {shown}{column} as review_text, Reviewer_Score, Hotel_Name, Hotel_City,
                  '{kind}' as type, cast(length({column}) as integer) as length from texts
                qualify row_number() over ({group} order by length({column}) {direction},
                  Hotel_Name, Hotel_City, Reviewer_Score, {column}) = 1"""
            )
    return f"with {TEXTS} " + " union all ".join(f"({part})" for part in parts)


def _try(kind: str, column: str) -> str:
    return f"try_cast({column} as {kind}) as {column}"


TYPED = f"""
star as (
  select l.*, s.*, p.*, o.o_custkey, o.o_orderpriority, c.c_nationkey, cn.n_name as rn_name,
    unnest(range(case when l.l_linenumber = 3 then 2 else 1 end)) as _copy
  from lineitem l join orders o on l.l_orderkey=o.o_orderkey
    join customer c on o.o_custkey=c.c_custkey join nation cn on c.c_nationkey=cn.n_nationkey
    join supplier s on l.l_suppkey=s.s_suppkey join part p on l.l_partkey=p.p_partkey
),
raw as (
  select
    case s_suppkey % 8
      when 0 then concat(s_suppkey, ' Low Road London NW1 6XE United Kingdom')
      when 1 then concat(s_suppkey, ' High Street London Mayfair Park W1K 6BD United Kingdom')
      when 2 then concat(s_suppkey, ' Long Lane  Leeds LS1 4AP United  Kingdom ')
      when 3 then concat(s_suppkey, ' Via Roma Milan Italy')
      when 4 then concat(s_suppkey, ' Rue de France Paris France')
      when 5 then concat('no nation ', s_suppkey)
      when 6 then 'Spain' end as Hotel_Address,
    case when l_partkey % 101 = 7 then '' else cast(l_partkey as varchar) end as Additional_Number_of_Scoring,
    case when l_partkey % 97 = 5 then '2017-13-40'
      else concat(month(l_shipdate), '/', day(l_shipdate), '/', year(l_shipdate)) end as Review_Date,
    cast(8e0 + (s_suppkey % 16)/16e0 as varchar) as Average_Score,
    s_name as Hotel_Name,
    case when c_nationkey % 9 = 4 then ' ' else concat(' ', rn_name, ' ') end as Reviewer_Nationality,
    case l_returnflag when 'A' then ' No Negative ' when 'R' then ''
      else concat(' ', o_orderpriority, ' ') end as Negative_Review,
    cast(l_linenumber as varchar) as Review_Total_Negative_Word_Counts,
    cast(s_suppkey + 1000 as varchar) as Total_Number_of_Reviews,
    case l_linenumber when 1 then '   ' when 2 then null
      else concat(' ', p_name, ' WITH ', p_type, ' ') end as Positive_Review,
    cast(l_linenumber + 2 as varchar) as Review_Total_Positive_Word_Counts,
    cast(o_custkey % 40 + 1 as varchar) as Total_Number_of_Reviews_Reviewer_Has_Given,
    cast(10e0 - l_quantity*l_quantity/256e0 as varchar) as Reviewer_Score,
    concat('['' ', o_orderpriority, ' '', '' ', p_type, ' '', '' ', l_returnflag, ' '']') as Tags,
    case when l_partkey % 89 = 3 then 'n/a' else concat(l_orderkey % 900, ' days') end as days_since_review,
    case when s_suppkey % 17 = 3 then 'NA'
      else cast(40e0 + s_nationkey/2e0 + ((s_suppkey*37) % 64 - 32)/1024e0 as varchar) end as lat,
    case when s_suppkey % 17 = 3 then 'NA'
      else cast(5e0 + s_nationkey/4e0 + ((s_suppkey*53) % 64 - 32)/1024e0 as varchar) end as lng
  from star
),
cast_raw as (
  select Hotel_Address,
    {_try('integer', 'Additional_Number_of_Scoring')},
    cast(try_strptime(Review_Date, '%m/%d/%Y') as date) as Review_Date,
    {_try('double', 'Average_Score')}, Hotel_Name, Reviewer_Nationality, Negative_Review,
    {_try('integer', 'Review_Total_Negative_Word_Counts')},
    {_try('integer', 'Total_Number_of_Reviews')}, Positive_Review,
    {_try('integer', 'Review_Total_Positive_Word_Counts')},
    {_try('integer', 'Total_Number_of_Reviews_Reviewer_Has_Given')},
    {_try('double', 'Reviewer_Score')},
    [trim(x, ' ') for x in string_split(regexp_replace(Tags, '[\\[\\]'']', '', 'g'), ', ')] as Tags,
    try_cast(regexp_extract(days_since_review, '([0-9]+)', 1) as integer) as days_since_review,
    {_try('double', 'lat')}, {_try('double', 'lng')},
    string_split(trim(regexp_replace(Hotel_Address, '\\s+', ' ', 'g'), ' '), ' ') as w,
    nullif(regexp_extract(trim(regexp_replace(Hotel_Address, '\\s+', ' ', 'g'), ' '),
      '(United\\s+Kingdom|\\b[A-Z][a-z]+)$', 1), '') as Hotel_Nationality
  from raw
),
placed as (
  select *, case when Hotel_Nationality = 'United Kingdom'
      then list_position(w, 'Kingdom') - case when list_contains(w, '6BD') then 6 else 4 end
      else list_position(w, Hotel_Nationality) - 1 end as place
  from cast_raw
),
typed as (
  select * exclude (w, place), case when place > 0 then w[place] end as Hotel_City from placed
)"""


def _flat(source: str, replaced: dict[str, str]) -> str:
    shown = []
    for name, kind in CLEAN.items():
        if name in replaced:
            shown.append(f"{replaced[name]} as {name}")
        elif name == "Tags":
            shown.append("array_to_string(Tags, '|') as Tags")
        elif name == "Review_Date":
            shown.append("cast(Review_Date as varchar) as Review_Date")
        elif kind == "double":
            shown.append(f"{_six(name)} as {name}")
        else:
            shown.append(name)
    return f"select {', '.join(shown)} from {source}"


def _profile(blanks: bool, shown: str) -> str:
    parts = []
    for name, kind in CLEAN.items():
        filled = f"{name} is not null"
        if blanks and kind == "string":
            filled += f" and trim({name}, ' ') <> ''"
        parts.append(
            f"select '{name}' as \"column\", '{kind}' as type, "
            f"count(*) filter ({filled}) as non_null, count(*) as total from typed"
        )
    return f"with {TYPED}, profile as ({' union all '.join(parts)}) select {shown} from profile"


def _blank_rows() -> str:
    tests = []
    for name, kind in CLEAN.items():
        tests.append(f"{name} is null")
        if kind == "string":
            tests.append(f"trim({name}, ' ') = ''")
    return f"with {TYPED} " + _flat("typed", {}) + " where " + " or ".join(tests)


def _clean() -> str:
    tidied = {
        name: f"coalesce(nullif(lower(trim({name}, ' ')), ''), '{default}')"
        for name, default in (
            ("Positive_Review", "No positive comment"),
            ("Negative_Review", "No negative comment"),
            ("Reviewer_Nationality", "Unknown"),
        )
    }
    return f"with {TYPED}, kept as (select distinct * from typed where {PRESENT}) " + _flat("kept", tidied)


_TAGS = f"with {REVIEWS}, tagged as (select unnest(Tags) as word, Reviewer_Score from reviews)"
_TAG_COUNTS = f'{_TAGS} select word, count(*) as "count" from tagged group by word'


def oracle_sql() -> dict[str, str]:
    by_season = f"""with {SCORED}
      select Season, {_six('avg(score)')} as Avg_Sentiment_Score from scored group by Season"""
    by_nation_season = f"""{SCORED},
      nation_season as (
        select Hotel_Nationality, Season, avg(score) as m from scored group by all)"""
    bins = """case when {0} is null then 'no data' when {0} < 0.37 then 'Sentiment < 0.37'
        when {0} < 0.39 then '0.37 <= Sentiment < 0.39' when {0} < 0.41 then '0.39 <= Sentiment < 0.41'
        else 'Sentiment >= 0.41' end"""
    parsed = "case " + " ".join(
        f"when sign(total) = {sign} then "
        + ("1" if "positive" in said.lower() else "0" if "neutral" in said.lower() else "-1")
        for sign, said in CHAT_OUTPUT.items()
    ) + " end"
    lat, lng = POINT
    sights = ", ".join(f"('{n.replace(chr(39), chr(39) * 2)}', {a}e0, {o}e0)" for _, n, a, o in POINTS_OF_INTEREST)
    seasonal = f"""with {SCORED},
          chosen as (select *, {parsed} as label from scored
            qualify row_number() over (partition by Hotel_Name, Season order by Review_Date, review_id) <= 5)
          select Hotel_Name, min(Hotel_Address) as Hotel_Address, Season,
            round(avg(label), 4) as Avg_Sentiment_Score, round(avg(Reviewer_Score), 4) as Avg_Review_Score,
            count(*) as Num_Reviews
          from chosen group by Hotel_Name, Season"""
    found = {
        "city_overview": f"""with {REVIEWS}
          select Hotel_City, count(*) as Total_Reviews, count(distinct Hotel_Name) as Number_Hotel,
            round(avg(Average_Score), 2) as Average_Score,
            count(*) filter (Reviewer_Score < 6) as TotalN, count(*) filter (Reviewer_Score > 6) as TotalP
          from reviews group by Hotel_City""",
        "top_hotels_by_city": f"""with {REVIEWS},
          hotel as (select Hotel_Nationality, Hotel_City, Hotel_Name, round(avg(Reviewer_Score), 3) as avg_score
            from reviews group by all),
          city as (select Hotel_Nationality, Hotel_City, avg(Reviewer_Score) as city_avg_score
            from reviews group by all),
          ranked as (select *, cast(row_number() over (partition by Hotel_Nationality, Hotel_City
            order by avg_score desc, Hotel_Name) as integer) as rank from hotel)
          select Hotel_Nationality, Hotel_City, {_six('city_avg_score')} as city_avg_score, Hotel_Name,
            avg_score, rank
          from ranked join city using (Hotel_Nationality, Hotel_City) where rank <= 5""",
        "cities_by_reviewer_nationality": f"""with {REVIEWS},
          scored as (select Reviewer_Nationality, Hotel_City, avg(Reviewer_Score) as avg_score
            from reviews group by all),
          ranked as (select *, cast(row_number() over (partition by Reviewer_Nationality
            order by avg_score desc, Hotel_City) as integer) as rank from scored)
          select Reviewer_Nationality, Hotel_City, {_six('avg_score')} as avg_score, rank
          from ranked where rank <= 10""",
        "unique_hotels": f"""with {REVIEWS}
          select distinct Hotel_Name, Hotel_City, {_six('lat')} as lat, {_six('lng')} as lng from reviews""",
        "reviewer_nationalities": f"""with {REVIEWS}
          select distinct Reviewer_Nationality from reviews where Reviewer_Nationality <> 'Unknown'""",
        "hotel_cities": f"with {REVIEWS} select distinct Hotel_City from reviews",
        "hotels_of_known_cities": f"""with {REVIEWS}, {_SITES}
          select Hotel_Name, Hotel_City, {_six('lat')} as lat, {_six('lng')} as lng,
            case when n_regionkey = 0 then concat('CITTA_', n_nationkey) else n_name end as city,
            {_six('40e0 + n_nationkey / 2e0')} as centre_lat, {_six('5e0 + n_nationkey / 4e0')} as centre_lng
          from sites join nation on Hotel_City = n_name""",
        "hotel_mean_score": f"""with {REVIEWS},
          m as (select Hotel_Name, round(avg(Reviewer_Score), 1) as avg_score from reviews group by all)
          select *, case when avg_score >= 8.5 then 'molto alto' when avg_score >= 7 then 'alto'
            when avg_score >= 5.5 then 'medio' else 'basso' end as band from m""",
        "hotel_monthly_trend": f"""with {REVIEWS}
          select Hotel_Name, cast(year(Review_Date) as integer) as anno, cast(month(Review_Date) as integer) as mese,
            strftime(Review_Date, '%Y-%m') as periodo, round(avg(Reviewer_Score), 1) as media_mensile
          from reviews group by all""",
        "hotel_reputation": f"""with {REVIEWS},
          r as (
            select Hotel_Name, avg(Reviewer_Score) as h,
              avg(Reviewer_Score) filter (date_diff('day', Review_Date,
                (select max(Review_Date) from reviews)) <= 30) as n
            from reviews group by Hotel_Name)
          select Hotel_Name, {_six('h')} as media_storica, {_six('n')} as media_ultimi_30gg,
            {_six('n - h')} as reputazione,
            case when n is null then 'sconosciuta' when n - h > 0 then 'migliorando' else 'peggiorando' end as andamento
          from r""",
        "anomalous_reviews": f"""with {REVIEWS},
          s as (select Hotel_Name, avg(Reviewer_Score) as a, stddev_samp(Reviewer_Score) as d
            from reviews group by Hotel_Name)
          select Hotel_Name, {_six('Reviewer_Score')} as Reviewer_Score, {_six('a')} as avg_score,
            {_six('d')} as stddev_score, Positive_Review, Negative_Review
          from reviews join s using (Hotel_Name) where abs(Reviewer_Score - a) > 2 * d""",
        "hotel_fact_sheet": f"""with {REVIEWS}
          select Hotel_Name, count(*) as Total_Reviews,
            count(*) filter (Reviewer_Score >= 6) as Total_Positive_Reviews,
            count(*) filter (Reviewer_Score < 6) as Total_Negative_Reviews,
            {_six('max(Reviewer_Score)')} as Max_Reviewer_Score, {_six('min(Reviewer_Score)')} as Min_Reviewer_Score,
            {_six('avg(Reviewer_Score)')} as Avg_Reviewer_Score,
            {_six('min((lat, lng))[1]')} as Latitude, {_six('min((lat, lng))[2]')} as Longitude
          from reviews group by Hotel_Name""",
        "hotels_near_hotel": f"""with {REVIEWS}, {_SITES},
          pairs as (
            select a.Hotel_Name, a.lat, a.lng, b.Hotel_Name as Nearby_Hotel, b.Hotel_City as Nearby_City,
              {_km('a.lat', 'a.lng', 'b.lat', 'b.lng')} as distanza
            from sites a, sites b where a.Hotel_Name <> b.Hotel_Name)
          select Hotel_Name, {_six('lat')} as lat, {_six('lng')} as lng, Nearby_Hotel, Nearby_City,
            {_six('distanza')} as distanza
          from pairs where distanza <= {PAIR_RADIUS_KM}e0""",
        "hotels_near_point": f"""with {REVIEWS}, {_SITES}, {_MEANS},
          near as (select *, {_km('lat', 'lng', f'{lat}e0', f'{lng}e0')} as distanza from sites)
          select Hotel_Name, Hotel_City, {_six('lat')} as lat, {_six('lng')} as lng,
            {_six('distanza')} as distanza, {_six('m')} as Avg_Score
          from near left join means using (Hotel_Name) where distanza <= {POINT_RADIUS_KM}e0""",
        "hotels_near_poi": f"""with {REVIEWS}, {_SITES}, {_MEANS},
          near as (
            select concat('Sight of ', n_name) as poi, sites.*,
              {_km('lat', 'lng', '(40e0 + n_nationkey / 2e0)', '(5e0 + n_nationkey / 4e0)')} as distanza
            from sites, nation)
          select poi, Hotel_Name, Hotel_City, {_six('lat')} as lat, {_six('lng')} as lng,
            {_six('distanza')} as distanza, {_six('m')} as Avg_Score
          from near left join means using (Hotel_Name) where distanza <= {SIGHT_RADIUS_KM}e0""",
        "word_scores": f"with {TEXTS}, {LEXICON} {_word_scores('positive')} union all {_word_scores('negative')}",
        "word_scores_benchmark": f"""with {TEXTS} {_word_scores('positive', known=_OF_BENCHMARK)}
          union all {_word_scores('negative', known=_OF_BENCHMARK)}""",
        "hotels_near_fixed_sights": f"""with {REVIEWS}, {_SITES}, {_MEANS},
          near as (
            select poi, sites.*, {_km('lat', 'lng', 'plat', 'plng')} as distanza
            from sites, (values {sights}) v(poi, plat, plng))
          select poi, Hotel_Name, Hotel_City, {_six('lat')} as lat, {_six('lng')} as lng,
            {_six('distanza')} as distanza, {_six('m')} as Avg_Score
          from near left join means using (Hotel_Name) where distanza <= {FIXED_SIGHT_RADIUS_KM}e0""",
        "word_scores_positive": f"""with {TEXTS}, {LEXICON}, w as ({_word_scores('positive')})
          select word, avg_score, word_count from w""",
        "word_scores_negative": f"""with {TEXTS}, {LEXICON}, w as ({_word_scores('negative')})
          select word, avg_score, word_count from w""",
        "word_scores_bare": f"""with {TEXTS}, {LEXICON}
          {_word_scores('positive', True, True)} union all {_word_scores('negative', True, True)}""",
        "tag_frequency": _TAG_COUNTS,
        "tags_top10": f'{_TAG_COUNTS} order by "count" desc, word limit 10',
        "tags_bottom10": f'{_TAG_COUNTS} order by "count", word desc limit 10',
        "tag_influence": f"""{_TAGS}
          select word as tag, {_six('avg(Reviewer_Score)')} as avg_score, count(*) as tag_count
          from tagged group by word having count(*) >= {TAG_MIN}""",
        "review_length_extremes": _extremes(None),
        "review_length_extremes_by_hotel": _extremes("Hotel_Name"),
        "sentiment_by_season": by_season,
        "sentiment_by_season_lexicon_table": by_season,
        "sentiment_by_hotel_season": f"""with {SCORED}
          select Season, Hotel_Name, min(Hotel_Address) as Hotel_Address,
            round(avg(score), 4) as Avg_Sentiment_Score, round(avg(Reviewer_Score), 4) as Avg_Review_Score,
            count(*) as Num_Reviews
          from scored group by Season, Hotel_Name""",
        "sentiment_by_nation_season": f"""with {by_nation_season}
          select Hotel_Nationality, Season, {_six('m')} as Avg_Sentiment_Score from nation_season""",
        "best_worst_season_by_nation": f"""with {by_nation_season},
          ranked as (
            select *, row_number() over (partition by Hotel_Nationality order by m desc, Season) as best,
              row_number() over (partition by Hotel_Nationality order by m, Season) as worst
            from nation_season)
          select Hotel_Nationality, max(Season) filter (best = 1) as Best_Season,
            {_six('max(m) filter (best = 1)')} as Best_Sentiment,
            max(Season) filter (worst = 1) as Worst_Season,
            {_six('max(m) filter (worst = 1)')} as Worst_Sentiment
          from ranked group by Hotel_Nationality""",
        "sentiment_by_nation": f"""with {SCORED},
          n as (select Hotel_Nationality as nation, round(avg(score), 3) as mean_sentiment from scored group by all)
          select *, {bins.format('mean_sentiment')} as bin from n""",
        "sentiment_map": f"""with {SCORED},
          n as (select lower(Hotel_Nationality) as nation, round(avg(score), 3) as sentiment from scored group by 1),
          outlines as (select distinct upper(lang) as name from documents union all select r_name from region)
          select name, sentiment, {bins.format('sentiment')} as bin
          from outlines left join n on lower(name) = nation""",
        "classified_sentiment": _label_counts(
            "case when score >= 0.05 then 'positive' when score <= -0.05 then 'negative' else 'neutral' end"
        ),
        "classified_sentiment_model": _label_counts(
            "case when total > 0 then 'positive' when total < 0 then 'negative' else 'neutral' end"
        ),
        "seasonal_label_stats": seasonal,
        "seasonal_label_stats_hot": seasonal,
        "review_digest": f"""with {TEXTS},
          two_sided as (select * from texts
            where lower(Positive_Review) not in ('no positive', 'no positive comment')
              and lower(Negative_Review) not in ('no negative', 'no negative comment')),
          ranked as (select *, row_number() over (partition by Hotel_Name
            order by activity, Positive_Review, Negative_Review) as rn from two_sided)
          select Hotel_Name, cast(count(*) as integer) as num_reviews,
            'Give me a detailed and elegant summary of the following reviews (Return only the summary itself):'
            || chr(10) || string_agg('Positiva: ' || Positive_Review || ' | Negativa: ' || Negative_Review || '. ',
              '' order by rn) as prompt
          from ranked where rn <= 50 group by Hotel_Name""",
        "hotel_summaries": f"""with {TEXTS},
          two_sided as (select Hotel_Name, count(*) as n from texts
            where lower(Positive_Review) not in ('no positive', 'no positive comment')
              and lower(Negative_Review) not in ('no negative', 'no negative comment')
            group by Hotel_Name)
          select Hotel_Name, cast(least(n, 50) as integer) as num_reviews,
            concat(least(n, 50), ' reviews') as summary from two_sided""",
        "model_output_text": """select conv_id, turn,
            regexp_replace(text, '^\\s+|\\s+$', '', 'g') as answer from conversations""",
        "clean_reviews": _clean(),
        "null_profile": _profile(True, '"column", non_null, total - non_null as missing'),
        "non_null_counts": _profile(False, '"column", non_null, total'),
        "table_info": _profile(False, '"column", type, non_null'),
        "rows_with_blanks": _blank_rows(),
    }
    one = {
        "hotel_fact_sheet_one": ("hotel_fact_sheet", "Hotel_Name", views.ONE_HOTEL),
        "top_hotels_one_city": ("top_hotels_by_city", "Hotel_City", views.ONE_CITY),
        "cities_one_nationality": ("cities_by_reviewer_nationality", "Reviewer_Nationality", views.ONE_CITY),
        "hotel_mean_score_one": ("hotel_mean_score", "Hotel_Name", views.ONE_HOTEL),
        "hotel_reputation_one": ("hotel_reputation", "Hotel_Name", views.ONE_HOTEL),
        "anomalous_reviews_one": ("anomalous_reviews", "Hotel_Name", views.ONE_HOTEL),
        "sentiment_one_nation": ("sentiment_by_nation_season", "Hotel_Nationality", views.ONE_NATION),
    }
    for name, (question, column, value) in one.items():
        found[name] = f"select * from ({found[question]}) everything where {column} = '{value}'"
    found["cities_by_known_nationality"] = (
        f"select * from ({found['cities_by_reviewer_nationality']}) everything where Reviewer_Nationality <> 'Unknown'"
    )
    # A city has few hotels in the given tables, so that its sketch counts them exactly.
    found["city_overview_of_sketches"] = found["city_overview"]
    found["hotels_near_point_by_name"] = found["hotels_near_point"]
    found["classified_sentiment_lexicon_table"] = found["classified_sentiment"]
    for question in ("anomalous_reviews", "review_digest"):
        found[f"{question}_hot"] = found[question]
    return found

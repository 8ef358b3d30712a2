"""The same queries in plain SQL over the same tables, for a second engine to check."""

from __future__ import annotations

# The stand-in tables of standins.py.
TABLES = r"""
street AS (
  SELECT *, concat(c_custkey % 400, ' Quai Bleu, ', 30000 + c_nationkey * 17, ' Ville ', c_nationkey) AS address
  FROM customer
),
employees AS (
  SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS nom, concat('P', c_custkey) AS prenom,
    CAST(DATE '1960-01-01' + CAST(c_custkey * 37 % 17500 AS INTEGER) AS DATE) AS date_naissance,
    CAST(DATE '2015-01-01' + CAST(c_custkey * 13 % 3400 AS INTEGER) AS DATE) AS date_embauche,
    c_mktsegment AS business_unit,
    CAST(20000 + floor(abs(c_acctbal)) * 5 AS DOUBLE) AS salaire_brut,
    CASE WHEN c_custkey % 10 = 0 THEN 'CDD' ELSE 'CDI' END AS contrat,
    CAST(25 + c_custkey % 5 AS INTEGER) AS nb_conges_payes,
    CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey % 50 = 7 THEN 'Chemin des Dunes, Mireval'
         ELSE address END AS adresse_complete,
    [' Marche/running ', 'VÉLO/Trottinette/Autres', 'Transports en commun',
     'véhicule thermique/électrique'][1 + c_custkey % 4] AS moyen_deplacement
  FROM street
),
sports AS (
  SELECT CAST(c_custkey AS INTEGER) AS id,
    CASE WHEN c_custkey % 5 = 1 THEN '' WHEN c_custkey % 5 > 1 THEN
      ['Runing', 'Randonnée', 'Triathlon', 'Natation', 'Tennis', 'Badminton', 'Tennis de table', 'Football',
       'Basketball', 'Rugby', 'Boxe', 'Judo', 'Escalade', 'Équitation', 'Pétanque'][1 + c_custkey % 15]
    END AS pratique_sport
  FROM customer
),
activities AS (
  SELECT event_id AS activity_id, CAST(user_id AS INTEGER) AS employee_id, concat('Session ', event_id) AS name,
    CAST(floor(value * 1000) AS INTEGER) AS distance_m,
    CAST(600 + event_id % 7200 AS INTEGER) AS moving_time_s, CAST(660 + event_id % 7200 AS INTEGER) AS elapsed_time_s,
    CAST(event_id % 800 AS INTEGER) AS total_elev_gain_m,
    CASE WHEN event_id % 2 = 0 THEN 'Run' ELSE 'Ride' END AS type,
    CASE WHEN event_id % 2 = 0 THEN 'Run' ELSE 'EBikeRide' END AS sport_type,
    ts AS start_date_utc, ts + INTERVAL 3600 SECOND AS start_date_local,
    '(GMT+01:00) Europe/Paris' AS timezone, CAST(3600 AS INTEGER) AS utc_offset_s,
    event_id % 3 = 0 AS commute, true AS manual, false AS private, false AS flagged,
    CAST(floor(floor(value * 1000) / 25) AS INTEGER) AS calories, props AS raw_payload, ts AS created_at
  FROM events
),
measured AS (
  SELECT DISTINCT address AS origin_address, '1 Place du Marché, 34000 Montpellier' AS destination_address,
    CASE WHEN c_nationkey % 7 <> 3 THEN CAST((c_nationkey * 1237 + c_custkey % 400 * 61) % 40000 AS INTEGER) END AS distance_m,
    CASE WHEN c_nationkey % 7 <> 3 THEN CAST((c_nationkey * 1237 + c_custkey % 400 * 61) % 40000 // 10 AS INTEGER) END AS duration_s,
    'google_maps' AS provider,
    CASE WHEN c_nationkey % 7 <> 3 THEN 'OK' ELSE 'ZERO_RESULTS' END AS status,
    CASE WHEN c_nationkey % 7 = 3 THEN 'ZERO_RESULTS' END AS error_message,
    c_nationkey, c_custkey % 10 AS kind
  FROM street
),
distances AS (
  SELECT *, TIMESTAMP '2024-01-01' AS last_updated FROM (
    SELECT origin_address, destination_address, distance_m, duration_s, provider, status, error_message
    FROM measured WHERE c_nationkey % 5 <> 2
    UNION ALL
    SELECT origin_address, '2 Quai Nord, 34200 Sète', 1, duration_s, provider, 'OK', error_message
    FROM measured WHERE c_nationkey % 5 <> 2 AND c_nationkey % 4 = 0
    UNION ALL
    SELECT origin_address, destination_address, 2, duration_s, 'other_maps', 'OK', error_message
    FROM measured WHERE c_nationkey % 5 <> 2 AND c_nationkey % 4 = 1)
),
answers AS (
  SELECT origin_address, destination_address,
    CASE WHEN state = 'OK' THEN distance_m END AS distance_m, CASE WHEN state = 'OK' THEN duration_s END AS duration_s,
    provider, state AS status, CASE WHEN state <> 'OK' THEN state END AS error_message
  FROM (SELECT *, CASE kind WHEN 0 THEN 'ERROR: ''rows''' WHEN 1 THEN 'ERROR: list index out of range'
          WHEN 2 THEN 'ERROR: ''distance''' WHEN 3 THEN 'ERROR: ''rows''' ELSE status END AS state
        FROM measured)
),
employee_log AS (
  SELECT 'r' AS op, id * 10 AS seq, * FROM employees
  UNION ALL
  SELECT 'u', id * 10 + 5, * REPLACE (
      concat((id + 1) % 400, ' Quai Bleu, ', 30000 + id % 25 * 17, ' Ville ', id % 25) AS adresse_complete,
      [' Marche/running ', 'VÉLO/Trottinette/Autres', 'Transports en commun',
       'véhicule thermique/électrique'][1 + (id + 1) % 4] AS moyen_deplacement)
  FROM employees WHERE id % 3 = 0
  UNION ALL
  SELECT 'u', id * 10 - 5, * REPLACE (1.0 AS salaire_brut) FROM employees WHERE id % 11 = 0
),
employees_now AS (
  SELECT * EXCLUDE (op, seq) FROM employee_log QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1
),
activity_log AS (
  SELECT activity_id * 10 AS seq, * FROM activities
  UNION ALL
  SELECT activity_id * 10 + 4, * REPLACE (employee_id + 1 AS employee_id, created_at + INTERVAL 1 DAY AS created_at)
  FROM activities WHERE activity_id % 6 = 0
  UNION ALL
  SELECT activity_id * 10 + 5, * REPLACE (start_date_utc - INTERVAL 366 DAY AS start_date_utc)
  FROM activities WHERE activity_id % 10 = 0
  UNION ALL
  SELECT activity_id * 10 - 5, * REPLACE (-1 AS distance_m) FROM activities WHERE activity_id % 14 = 0
),
activities_now AS (
  SELECT * FROM activity_log QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY seq DESC) = 1
),
"""


def _silver(employees: str, activities: str, distances: str) -> str:
    """Silver and gold over the named tables."""
    return rf"""
employee AS (
  SELECT id AS employee_id, nom, prenom,
    date_naissance, CAST(day(date_naissance) AS INTEGER) AS jour_naissance,
    CAST(month(date_naissance) AS INTEGER) AS mois_naissance, CAST(year(date_naissance) AS INTEGER) AS annee_naissance,
    date_embauche, CAST(day(date_embauche) AS INTEGER) AS jour_embauche,
    CAST(month(date_embauche) AS INTEGER) AS mois_embauche, CAST(year(date_embauche) AS INTEGER) AS annee_embauche,
    business_unit, salaire_brut, contrat, nb_conges_payes, adresse_complete,
    regexp_extract(adresse_complete, '(\d{{5}})', 1) AS code_postal,
    trim(regexp_extract(adresse_complete, '\d{{5}}\s+(.*)$', 1)) AS ville, moyen_deplacement,
    CAST(floor(date_diff('day', date_naissance, DATE '2024-06-30') / CAST(365.25 AS DOUBLE)) AS BIGINT) AS age_annees,
    CAST(floor(date_diff('day', date_embauche, DATE '2024-06-30') / CAST(365.25 AS DOUBLE)) AS BIGINT) AS anciennete_annees
  FROM {employees}
),
commute AS (
  SELECT employee_id, adresse_complete, code_postal, ville, moyen_deplacement FROM employee
),
enriched AS (
  SELECT c.*, d.distance_m AS distance_domicile_travail_m, d.duration_s AS duree_domicile_travail_s
  FROM commute c LEFT JOIN {distances} d
    ON c.adresse_complete = d.origin_address AND d.status = 'OK' AND d.provider = 'google_maps'
    AND d.destination_address = '1 Place du Marché, 34000 Montpellier'
),
bonus_input AS (
  SELECT e.employee_id, CAST(2024 AS INTEGER) AS year, e.business_unit, e.salaire_brut, c.moyen_deplacement,
    c.distance_domicile_travail_m, lower(trim(c.moyen_deplacement)) AS mode_normalise,
    c.distance_domicile_travail_m / CAST(1000 AS DOUBLE) AS distance_km
  FROM employee e JOIN enriched c USING (employee_id)
),
bonus AS (
  SELECT *, CASE WHEN eligible THEN salaire_brut * CAST(0.05 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS bonus_amount FROM (
    SELECT *, coalesce((starts_with(mode_normalise, 'marche/running') AND distance_km <= 15)
                    OR (starts_with(mode_normalise, 'vélo/trottinette') AND distance_km <= 25), false) AS eligible
    FROM bonus_input)
),
sport_profile AS (
  SELECT id AS employee_id,
    CASE WHEN pratique_sport IS NULL OR pratique_sport = '' THEN 'Aucune' ELSE pratique_sport END AS pratique_sport
  FROM sports
),
activity AS (
  SELECT activity_id, employee_id, start_date_utc AS activity_datetime_utc, CAST(start_date_utc AS DATE) AS activity_date,
    CAST(year(start_date_utc) AS INTEGER) AS activity_year, sport_type, type, distance_m, moving_time_s, elapsed_time_s
  FROM {activities}
),
wellbeing AS (
  SELECT employee_id, activity_year AS year, count(*) AS nb_activities_year,
    min(activity_date) AS first_activity_date, max(activity_date) AS last_activity_date
  FROM activity WHERE activity_year = 2024 GROUP BY employee_id, activity_year
)
"""


BATCH = "WITH " + TABLES + _silver("employees", "activities", "distances")

# After the change topics and the answers to what the cache did not hold.
CURRENT = (
    "WITH " + TABLES + """
distances_now AS (
  SELECT origin_address, destination_address, distance_m, duration_s, provider, status FROM distances
  UNION ALL
  SELECT origin_address, destination_address, distance_m, duration_s, provider, status FROM answers a
  WHERE NOT EXISTS (SELECT 1 FROM distances d WHERE d.origin_address = a.origin_address
                    AND d.destination_address = a.destination_address)
),
""" + _silver("employees_now", "activities_now", "distances_now")
)

_IMPACT = """
  count(*) AS employees, count(*) FILTER (WHERE eligible) AS eligible_employees,
  coalesce(sum(salaire_brut) FILTER (WHERE eligible), 0) * CAST(0.05 AS DOUBLE) AS total_bonus FROM bonus"""
_WELLBEING_DAYS = """*, nb_activities_year >= 15 AS eligible,
  CAST(CASE WHEN nb_activities_year >= 15 THEN 5 ELSE 0 END AS INTEGER) AS extra_days"""

_REQUESTS = """
SELECT DISTINCT {what} FROM commute c
WHERE adresse_complete IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM distances d WHERE d.origin_address = c.adresse_complete
  AND d.destination_address = '1 Place du Marché, 34000 Montpellier'{known})"""
_PAIR = "adresse_complete AS origin_address, '1 Place du Marché, 34000 Montpellier' AS destination_address"
_REQUEST_JSON = (
    "to_json({'origin_address': adresse_complete, "
    "'destination_address': '1 Place du Marché, 34000 Montpellier'}) AS value"
)
_ADDED_ANSWERS = """
  SELECT * FROM answers a WHERE NOT EXISTS (SELECT 1 FROM distances d WHERE d.origin_address = a.origin_address
    AND d.destination_address = a.destination_address AND d.provider = a.provider)"""

_TAXONOMY = """, historic(practice, t, st) AS (VALUES
  ('Runing', 'Run', 'Run'), ('Randonnée', 'Walk', 'Hike'), ('Triathlon', 'Workout', 'Triathlon'),
  ('Natation', 'Swim', 'Swim'), ('Tennis', 'Workout', 'Tennis'), ('Badminton', 'Workout', 'Badminton'),
  ('Tennis de table', 'Workout', 'TableTennis'), ('Football', 'Workout', 'Soccer'),
  ('Basketball', 'Workout', 'Basketball'), ('Rugby', 'Workout', 'Rugby'), ('Boxe', 'Workout', 'Boxing'),
  ('Judo', 'Workout', 'MartialArts'), ('Escalade', 'Workout', 'RockClimbing'),
  ('Équitation', 'Ride', 'EBikeRide'), ('Voile', 'Workout', 'Sailing')),
live AS (
  SELECT practice, CASE practice WHEN 'Randonnée' THEN 'Hike' WHEN 'Équitation' THEN 'Workout' ELSE t END AS t,
    CASE practice WHEN 'Équitation' THEN 'HorseRiding' ELSE st END AS st FROM historic)
SELECT s.id, s.pratique_sport, coalesce(h.t, 'Workout') AS historic_type,
  coalesce(h.st, 'Workout') AS historic_sport_type, coalesce(l.t, 'Workout') AS type,
  coalesce(l.st, nullif(s.pratique_sport, ''), 'Workout') AS sport_type
FROM sports s LEFT JOIN historic h ON h.practice = s.pratique_sport LEFT JOIN live l ON l.practice = s.pratique_sport"""

_NOTIFICATION = """SELECT {key} a.employee_id,
  coalesce(e.prenom || ' ' || e.nom, 'Employé ' || a.employee_id) AS employee_fullname,
  e.prenom AS employee_firstname, e.nom AS employee_lastname,
  round(a.distance_m / CAST(1000 AS DOUBLE), 1) AS distance_km, a.name AS activity_name
FROM {source} a LEFT JOIN employees e ON e.id = a.employee_id AND e.id % 6 <> 0"""

_ANSWERED = f"""
        SELECT * EXCLUDE (last_updated) FROM distances
        UNION ALL BY NAME
        SELECT a.* FROM ({_ADDED_ANSWERS}) a
        WHERE a.origin_address IN (SELECT adresse_complete FROM commute)"""

_LOADED = """SELECT b.*, w.nb_activities_year,
          CAST(CASE WHEN w.nb_activities_year >= 15 THEN 5 WHEN w.nb_activities_year IS NOT NULL THEN 0 END AS INTEGER) AS extra_days
        FROM bonus b LEFT JOIN wellbeing w USING (employee_id)"""

_DQ_SILVER = """, checks AS (
          SELECT 'silver.employee' AS table_name, 'volume' AS check_name, count(*) AS measured, count(*) >= 1 AS passed FROM employee
          UNION ALL SELECT 'silver.employee', 'birth date in the past', count(*) FILTER (WHERE NOT date_naissance < DATE '2024-06-30'),
            count(*) FILTER (WHERE NOT date_naissance < DATE '2024-06-30') = 0 FROM employee
          UNION ALL SELECT 'silver.employee', 'of age', count(*) FILTER (WHERE NOT age_annees >= 18),
            count(*) FILTER (WHERE NOT age_annees >= 18) = 0 FROM employee
          UNION ALL SELECT 'silver.commute', 'volume', count(*), count(*) >= 1 FROM commute
          UNION ALL SELECT 'silver.sport_profile', 'volume', count(*), count(*) >= 1 FROM sport_profile
          UNION ALL SELECT 'silver.activity', 'volume', count(*), count(*) >= 1 FROM activity
          UNION ALL SELECT 'silver.employee', 'unique employee_id', count(*), count(*) = 0
            FROM (SELECT employee_id FROM employee GROUP BY 1 HAVING count(*) > 1)
          UNION ALL SELECT 'silver.commute', 'unique employee_id', count(*), count(*) = 0
            FROM (SELECT employee_id FROM commute GROUP BY 1 HAVING count(*) > 1)
          UNION ALL SELECT 'silver.sport_profile', 'unique employee_id', count(*), count(*) = 0
            FROM (SELECT employee_id FROM sport_profile GROUP BY 1 HAVING count(*) > 1)
          UNION ALL SELECT 'silver.activity', 'unique activity_id', count(*), count(*) = 0
            FROM (SELECT activity_id FROM activity GROUP BY 1 HAVING count(*) > 1))
        SELECT * FROM checks"""

_BATCH_QUERIES = {
    "silver_employee": "SELECT * FROM employee",
    "silver_commute": "SELECT * FROM commute",
    "silver_sport_profile": "SELECT * FROM sport_profile",
    "silver_activity": "SELECT * FROM activity",
    "commute_enriched": "SELECT * FROM enriched",
    "gold_bonus_input": "SELECT * FROM bonus_input",
    "bonus_eligibility": "SELECT * FROM bonus",
    "bonus_impact_by_unit": f"SELECT business_unit, {_IMPACT} GROUP BY business_unit",
    "bonus_total": f"SELECT {_IMPACT}",
    "gold_wellbeing": "SELECT * FROM wellbeing",
    "wellbeing_eligibility": f"SELECT {_WELLBEING_DAYS} FROM wellbeing",
    "wellbeing_by_year": f"""SELECT {_WELLBEING_DAYS} FROM (
        SELECT CAST(o_custkey AS INTEGER) AS employee_id, CAST(year(o_orderdate) AS INTEGER) AS year,
          count(*) AS nb_activities_year, min(CAST(o_orderdate AS DATE)) AS first_activity_date,
          max(CAST(o_orderdate AS DATE)) AS last_activity_date
        FROM orders GROUP BY 1, 2)""",
    "v_prime_sportive": """SELECT employee_id, year, business_unit, salaire_brut, moyen_deplacement, distance_km
        FROM bonus_input""",
    "v_wellbeing": """SELECT employee_id, year, nb_activities_year,
        CAST(first_activity_date AS TIMESTAMP) AS first_activity_date,
        CAST(last_activity_date AS TIMESTAMP) AS last_activity_date FROM wellbeing""",
    "sporting_employees": """SELECT id AS employee_id, nom, prenom, pratique_sport
        FROM employees JOIN sports USING (id) WHERE pratique_sport IS NOT NULL""",
    "activity_taxonomy": _TAXONOMY,
    "activity_measures": """SELECT activity_id, CASE WHEN seconds > 0 THEN metres / seconds ELSE 0 END AS average_speed,
          CAST(CASE WHEN metres > 0 THEN floor(metres * CAST(0.04 AS DOUBLE)) ELSE seconds // 10 END AS INTEGER) AS calories,
          start_date_utc + to_seconds(utc_offset_s) AS start_date_local
        FROM (SELECT *, CASE WHEN activity_id % 5 = 0 THEN 0 ELSE distance_m END AS metres,
                CASE WHEN activity_id % 9 = 0 THEN 0 ELSE moving_time_s END AS seconds FROM activities)""",
    "notification_payloads": _NOTIFICATION.format(key="a.activity_id,", source="activities"),
    "distance_requests": _REQUESTS.format(what=_REQUEST_JSON, known=""),
    "distance_requests_retry": _REQUESTS.format(what=_REQUEST_JSON, known=" AND d.status = 'OK'"),
    "distance_answers": "SELECT * FROM answers",
    "distance_cache_upsert": f"""
        SELECT d.origin_address, d.destination_address, d.provider,
          CASE WHEN a.status IS NULL THEN d.distance_m ELSE a.distance_m END AS distance_m,
          CASE WHEN a.status IS NULL THEN d.duration_s ELSE a.duration_s END AS duration_s,
          coalesce(a.status, d.status) AS status,
          CASE WHEN a.status IS NULL THEN d.error_message ELSE a.error_message END AS error_message,
          CASE WHEN a.status IS NULL THEN d.last_updated ELSE TIMESTAMP '2024-06-30' END AS last_updated
        FROM distances d LEFT JOIN answers a USING (origin_address, destination_address, provider)
        UNION ALL
        SELECT origin_address, destination_address, provider, distance_m, duration_s, status, error_message,
          TIMESTAMP '2024-06-30' FROM ({_ADDED_ANSWERS})""",
    "csv_landing_employees": "SELECT * REPLACE (CAST(id + 1 AS INTEGER) AS id) FROM employees",
    "csv_landing_both": """SELECT CAST(id + 1 AS INTEGER) AS id, nom, date_naissance, nullif(pratique_sport, '') AS pratique_sport
        FROM employees JOIN sports USING (id)""",
    "jsonl_landing": """SELECT * EXCLUDE (raw_payload, created_at) REPLACE (
          CASE WHEN activity_id % 8 <> 0 THEN employee_id END AS employee_id,
          CASE WHEN activity_id % 12 <> 0 THEN date_trunc('second', start_date_utc) END AS start_date_utc,
          date_trunc('second', start_date_local) AS start_date_local), true AS raw_matches
        FROM activities""",
    "bronze_snapshots": """SELECT 'rh_employees' AS table_name, count(*) AS row_count FROM employees
        UNION ALL SELECT 'sport_activities', count(*) FROM sports
        UNION ALL SELECT 'strava_activities', count(*) FROM activities""",
    "bronze_employees": "SELECT * FROM employees",
    "external_table": "SELECT pratique_sport, count(*) AS declarations FROM sports GROUP BY pratique_sport",
    "dq_silver": _DQ_SILVER,
    "dq_observed": _DQ_SILVER,
    "dq_duplicated_keys": """SELECT address, count(*) AS occurrences
        FROM (SELECT CASE WHEN id % 9 <> 0 THEN adresse_complete END AS address FROM employees)
        GROUP BY address HAVING count(*) > 1""",
    "dq_schema_failures": """SELECT * FROM (
          SELECT 'id' AS column_name, 'dtype(int)' AS check_name, 'x' AS value, prenom AS row_key FROM employees WHERE id % 10 = 1
          UNION ALL SELECT 'id', 'greater_than(0)', '-3', prenom FROM employees WHERE id % 10 = 2
          UNION ALL SELECT 'id', 'greater_than(0)', '0', prenom FROM employees WHERE id = 0
          UNION ALL SELECT 'nom', 'str_length(1, None)', '', prenom FROM employees WHERE id % 10 = 3
          UNION ALL SELECT 'nom', 'not_nullable', NULL, prenom FROM employees WHERE id % 10 = 4
          UNION ALL SELECT 'salaire_brut', 'greater_than(0)', '0', prenom FROM employees WHERE id % 10 = 5
          UNION ALL SELECT 'nb_conges_payes', 'in_range(0, 100)', '101', prenom FROM employees WHERE id % 10 = 7)""",
    "pruned_lookup": """SELECT o_orderkey,
          CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2030-01-01' ELSE o_orderdate END AS created_at
        FROM orders WHERE o_orderkey % 21 <> 0 AND o_orderkey IN (SELECT c_custkey * 5 FROM customer)""",
    "change_feed": """SELECT activity_id, CASE WHEN activity_id % 9 <> 4 THEN employee_id END AS employee_before,
          CAST(CASE WHEN activity_id % 15 = 0 THEN employee_id
               WHEN activity_id % 6 = 0 THEN employee_id + 1
               WHEN activity_id % 9 = 4 AND activity_id % 10 = 1 THEN -1 ELSE employee_id END AS INTEGER) AS employee_after,
          activity_id % 15 = 0 AS removed, activity_date AS day
        FROM activity WHERE activity_id % 6 = 0 OR activity_id % 15 = 0 OR activity_id % 9 = 4""",
    "landing_key_conflicts": """SELECT id, CASE WHEN id % 30 = 0 THEN 'repeated' ELSE 'present' END AS problem FROM employees WHERE id % 6 = 0
        UNION ALL SELECT DISTINCT CAST(NULL AS INTEGER), 'missing' FROM employees WHERE id % 50 = 1""",
    "dq_incremental": """, parents AS (
          SELECT id FROM employees
          UNION ALL SELECT id FROM employees WHERE id % 4 <> 1 AND id % 7 = 2 AND id % 14 <> 2
        ), children AS (SELECT CASE WHEN activity_id % 6 = 0 THEN -employee_id - 1 ELSE employee_id END AS id FROM activities),
        found AS (
          SELECT 'unique' AS check_name, count(*) AS measured FROM (SELECT id FROM parents GROUP BY id HAVING count(*) > 1)
          UNION ALL SELECT 'references', count(*) FROM children c WHERE NOT EXISTS (SELECT 1 FROM parents p WHERE p.id = c.id))
        SELECT *, measured = 0 AS passed FROM found""",
    "schema_change": """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(CASE WHEN c_custkey % 3 = 0 THEN floor(c_acctbal) ELSE c_acctbal END AS DOUBLE) AS c_acctbal,
          CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer""",
    "dq_orphans": """SELECT employee_id, count(*) AS child_rows FROM (
          SELECT CAST(-employee_id - 1 AS INTEGER) AS employee_id FROM activities WHERE employee_id % 20 = 0
          UNION ALL SELECT employee_id FROM activities WHERE employee_id % 20 > 1) a
        WHERE NOT EXISTS (SELECT 1 FROM employees e WHERE e.id = a.employee_id) GROUP BY employee_id""",
    "dq_constraints": """, found AS (
          SELECT 'rh_employees' AS table_name, 'volume' AS check_name, count(*) AS measured FROM employees
          UNION ALL SELECT 'rh_employees', 'not null id', count(*) FILTER (WHERE id IS NULL) FROM employees
          UNION ALL SELECT 'rh_employees', 'not null nom', count(*) FILTER (WHERE nom IS NULL) FROM employees
          UNION ALL SELECT 'rh_employees', 'not null prenom', count(*) FILTER (WHERE prenom IS NULL) FROM employees
          UNION ALL SELECT 'rh_employees', 'not null adresse_complete', count(*) FILTER (WHERE adresse_complete IS NULL) FROM employees
          UNION ALL SELECT 'rh_employees', 'unique id', count(*) FROM (SELECT id FROM employees GROUP BY 1 HAVING count(*) > 1)
          UNION ALL SELECT 'distance_cache', 'volume', count(*) FROM distances
          UNION ALL SELECT 'distance_cache', 'not null origin_address', count(*) FILTER (WHERE origin_address IS NULL) FROM distances
          UNION ALL SELECT 'distance_cache', 'not null destination_address', count(*) FILTER (WHERE destination_address IS NULL) FROM distances
          UNION ALL SELECT 'distance_cache', 'not null status', count(*) FILTER (WHERE status IS NULL) FROM distances
          UNION ALL SELECT 'distance_cache', 'unique origin_address, destination_address, provider', count(*)
            FROM (SELECT 1 FROM distances GROUP BY origin_address, destination_address, provider HAVING count(*) > 1)
          UNION ALL SELECT 'distance_cache', 'unique origin_address, destination_address', count(*)
            FROM (SELECT 1 FROM distances GROUP BY origin_address, destination_address HAVING count(*) > 1)
          UNION ALL SELECT 'strava_activities', 'references employee_id', count(*) FROM activities a
            WHERE employee_id % 20 = 0 OR (employee_id % 20 > 1 AND NOT EXISTS (SELECT 1 FROM employees e WHERE e.id = a.employee_id)))
        SELECT *, CASE WHEN check_name = 'volume' THEN measured >= 1 ELSE measured = 0 END AS passed FROM found""",
    "cdc_parse": "SELECT * REPLACE (CAST(seq AS BIGINT) AS seq) FROM employee_log",
    "cdc_rejected": """SELECT 'no operation' AS reason, count(*) AS messages
        FROM (SELECT id FROM employee_log UNION ALL SELECT id FROM employees WHERE id % 13 = 0) WHERE id % 17 = 0
        UNION ALL SELECT 'unreadable start_date_utc', count(*) FROM activity_log WHERE activity_id % 9 = 0""",
    "cdc_latest": "SELECT * FROM activities_now",
    "upsert_all": """SELECT o_orderkey,
          CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2030-01-01' ELSE o_orderdate END AS created_at
        FROM orders""",
    "upsert_set_once": """SELECT o_orderkey,
          CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 15 = 0 THEN TIMESTAMP '2030-01-01' ELSE o_orderdate END AS created_at
        FROM orders""",
    "keyed_table": """SELECT o_orderkey,
          CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 15 = 0 THEN TIMESTAMP '2030-01-01' ELSE o_orderdate END AS created_at
        FROM orders WHERE o_orderkey % 21 <> 0""",
    "stream_cdc_upsert": """SELECT n.* EXCLUDE (seq) REPLACE (o.created_at AS created_at) FROM activities_now n
        JOIN (SELECT * FROM activity_log QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY seq) = 1) o
        USING (activity_id)""",
    "cdc_order": """SELECT activity_id, CAST(CASE WHEN activity_id % 6 = 0 AND activity_id % 10 <> 0 THEN employee_id + 1 ELSE employee_id END AS INTEGER) AS employee_id,
          CAST(CASE WHEN activity_id % 14 = 0 AND activity_id % 6 <> 0 AND activity_id % 10 <> 0 THEN -1 ELSE distance_m END AS INTEGER) AS distance_m,
          CASE WHEN activity_id % 10 = 0 THEN start_date_utc - INTERVAL 366 DAY ELSE start_date_utc END AS start_date_utc
        FROM activities""",
    "cdc_no_key": "SELECT 'no key' AS reason, count(*) AS messages FROM activities WHERE activity_id % 50 = 1",
    "stream_wellbeing_complete": "SELECT * FROM wellbeing",
    "stream_wellbeing_update": "SELECT * FROM wellbeing",
    "stream_notifications_once": _NOTIFICATION.format(key="", source="activities"),
    "stream_restart": _NOTIFICATION.format(key="", source="activities"),
    "stream_distance_answers": _ANSWERED,
    "stream_late_answers": _ANSWERED,
    "stream_distance_requests_all": f"""
        SELECT {_PAIR} FROM (SELECT DISTINCT adresse_complete FROM employee_log) c
        WHERE adresse_complete IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM distances d WHERE d.origin_address = c.adresse_complete
          AND d.destination_address = '1 Place du Marché, 34000 Montpellier')""",
    "stream_notifications": _NOTIFICATION.format(
        key="", source="(SELECT * FROM activities UNION ALL SELECT * FROM activities WHERE activity_id % 9 = 0)"
    ),
    "full_load_gold": _LOADED,
    "full_load_landed_twice": _LOADED,
}

_CURRENT_QUERIES = {
    "stream_cycle": """SELECT b.*, CASE WHEN b.employee_id % 4 = 0 THEN 'Voile' ELSE p.pratique_sport END AS pratique_sport,
          w.nb_activities_year, w.first_activity_date, w.last_activity_date
        FROM bonus_input b JOIN sport_profile p USING (employee_id) LEFT JOIN wellbeing w USING (employee_id)""",
    "stream_wellbeing_recompute": "SELECT * FROM wellbeing",
    "stream_wellbeing_delta": """SELECT employee_id, activity_year AS year, count(*) AS nb_activities_year,
          min(activity_date) AS first_activity_date, max(activity_date) AS last_activity_date
        FROM activity WHERE activity_year = 2024 AND activity_id % 15 <> 0 GROUP BY ALL""",
    "stream_distance_requests": f"""
        SELECT {_PAIR} FROM (SELECT DISTINCT adresse_complete FROM commute) c
        WHERE adresse_complete IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM distances d WHERE d.origin_address = c.adresse_complete
          AND d.destination_address = '1 Place du Marché, 34000 Montpellier')""",
}


def all_oracles() -> dict[str, str]:
    return {name: f"{BATCH} {sql}" for name, sql in _BATCH_QUERIES.items()} | {
        name: f"{CURRENT} {sql}" for name, sql in _CURRENT_QUERIES.items()
    }

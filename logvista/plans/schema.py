"""Schemas of the raw records and of the releases, as Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = [
    "record_id", "event_time", "actor_email_hash", "ip_hash", "ip_version", "ip_country", "ip_region", "ip_city", "continent", "latitude", "longitude",
    "event_name", "is_suspicious", "login_type", "login_challenge_method", "login_status",
]
REQUIRED = ["event_time", "actor_email_hash", "ip_hash", "ip_version", "ip_country", "is_suspicious", "login_type", "login_challenge_method"]

_S, _I, _L, _D, _T = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()

#: name, type, nullable
_PUBLIC = [
    ("event_id", _S, False), ("actor_pseudo_id", _S, False), ("event_time_hour_utc", _T, False), ("event_hour", _I, False), ("day_of_week", _I, False), ("month", _I, False), ("is_weekend", _I, False),
    ("prior_event_count", _L, False), ("hours_since_last_login", _D, True), ("hours_since_first_observed_login", _D, False), ("logins_24h", _L, False), ("logins_7d", _L, False), ("logins_30d", _L, False),
    ("login_rate_30d", _D, False), ("active_days_30d", _I, False),
    ("actor_network_id", _S, True), ("ip_version", _I, True), ("is_new_ip", _I, True), ("ip_changed", _I, True),
    ("distinct_networks_24h", _I, False), ("distinct_networks_7d", _I, False), ("distinct_networks_30d", _I, False), ("networks_seen_to_date", _L, False),
    ("ip_country", _S, True), ("continent", _S, True), ("is_new_country", _I, True), ("country_changed", _I, True), ("is_new_continent", _I, True), ("continent_changed", _I, True),
    ("distinct_countries_24h", _I, False), ("distinct_countries_7d", _I, False), ("distinct_countries_30d", _I, False), ("distinct_countries_to_date", _L, False),
    ("login_type", _S, True), ("login_challenge_method", _S, True), ("is_new_login_type", _I, True), ("login_type_changed", _I, True), ("is_new_challenge", _I, True), ("challenge_changed", _I, True),
    ("distinct_login_types_30d", _I, False), ("distinct_challenges_30d", _I, False), ("provider_suspicious", _I, False),
]
_RESTRICTED = [
    ("event_time", _T, False), ("institution_pseudo_id", _S, False), ("network_pseudo_id", _S, True), ("ip_city", _S, True), ("latitude", _D, True), ("longitude", _D, True),
    ("travel_distance_km", _D, True), ("travel_speed_kmh", _D, True),
]
PUBLIC_42 = T.StructType([T.StructField(*f) for f in _PUBLIC])
RESTRICTED_50 = T.StructType([T.StructField(*f) for f in _PUBLIC + _RESTRICTED])

# The earlier narrow contract, whose columns and their order are part of it.
LEGACY_20 = [
    "event_id", "actor_pseudo_id", "event_time_hour_utc", "ip_country", "ip_version", "login_type", "login_challenge_method", "prior_event_count", "history_available",
    "hours_since_last_login", "hours_since_first_observed_login", "logins_24h", "logins_7d", "logins_30d", "is_new_ip", "is_new_country", "country_changed",
    "countries_seen_24h", "countries_seen_30d", "provider_suspicious",
]
LEGACY_35 = LEGACY_20 + [
    "event_time", "institution_pseudo_id", "source_file_id", "network_pseudo_id", "actor_email_hash", "ip_hash", "ip_region", "ip_city", "continent", "latitude", "longitude",
    "continent_changed", "travel_distance_km", "travel_speed_kmh", "is_impossible_travel",
]

# What a release must not hold.
FORBIDDEN_PUBLIC = {
    "event_time", "network_pseudo_id", "actor_email_hash", "ip_hash", "institution_pseudo_id", "source_file_id", "ip_region", "ip_city", "latitude", "longitude", "travel_distance_km",
    "travel_speed_kmh", "is_impossible_travel", "risk_score", "risk_level", "label", "record_id", "source_file", "history_available",
}
FORBIDDEN_LEGACY = FORBIDDEN_PUBLIC - {"history_available"}
FORBIDDEN_RESTRICTED = {"risk_score", "risk_level", "label", "distinct_ips_7d", "distinct_ips_30d", "distinct_users_per_network_24h", "geo_source"}

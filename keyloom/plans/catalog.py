"""All signals by name, and plans that compute many of them over one exchange and sort."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.tables import broadcast_small, written
from keyloom.operators import anchored, machines, ranges, rolling, rules, streaks
from keyloom.operators.kernels import KEY, TIE, TIME, unexpire, with_life
from keyloom.operators.slices import cut_slices


@dataclass(frozen=True)
class Signal:
    """A signal: the kind of event it reads, the function from events to alerts, and its live state's time to live in hours."""

    kind: str
    make: Callable[..., DataFrame]
    ttl_hours: int | None = 48


#: The fields besides key, time and ``event_id`` that a signal reads, where its slices carry no more: each level of these writes its rows.
READS = {
    "auth_velocity_spike": (), "auth_otp_fallback": ("eventId", "authType"), "auth_duration_outlier": ("authDuration",), "auth_geo_drift": ("locationStateCode", "locationDistrictCode"),
    "auth_retry_session": ("authResult",), "auth_rapid_device_switch": ("eventId", "deviceCode"), "auth_high_risk_hours": ("eventId", "authResult"), "auth_error_hotspot": ("subErrorCode",), "auth_time_entropy": (),
}


def _t(make: Callable[..., DataFrame], ttl: int | None = 48) -> Signal:
    return Signal("txn", make, ttl)


def _b(make: Callable[..., DataFrame], ttl: int | None = 48) -> Signal:
    return Signal("bio", make, ttl)


SIGNALS: dict[str, Signal] = {
    "auth_txn_counts": _t(streaks.counts, None), "auth_txn_gaps": _t(streaks.gaps), "auth_txn_gap_avg": _t(streaks.gap_average), "auth_retry_session": _t(streaks.retry),
    "auth_txn_oddhour_ratio": _t(streaks.odd_hours), "auth_liveness_streak": _t(streaks.liveness_streak, 24), "auth_failure_streak": _t(streaks.failure_streak),
    "auth_bot_recovery_speed": _t(streaks.recovery_speed), "auth_brute_force": _t(ranges.brute_force, 24), "auth_ghost_uptime": _t(streaks.ghost_uptime), "auth_dormancy": _t(streaks.dormancy, None),
    "auth_packet_replay": _t(streaks.packet_replay, 24), "auth_rd_software_change": _t(streaks.software_changes), "auth_cross_border": _t(streaks.cross_border),
    "auth_failure_rate": _t(machines.failure_rate), "auth_otp_fallback": _t(rolling.otp_fallback), "auth_success_without_bio": _t(rolling.success_without_bio),
    "auth_location_mismatch": _t(rolling.location_mismatch), "auth_night_surge": _t(rolling.night_surge, 24), "auth_success_cliff": _t(rolling.success_cliff),
    "auth_modality_switch": _t(rolling.modality_switch), "auth_finger_decline": _t(rolling.finger_decline), "auth_face_decline": _t(rolling.face_decline), "auth_fmr_spread": _t(rolling.fmr_spread),
    "auth_biometric_replay": _t(rolling.biometric_replay), "auth_time_entropy": _t(rolling.time_entropy, 24), "auth_duration_outlier": _t(rolling.duration_outlier),
    "auth_pid_size_anomaly": _t(rolling.pid_size_anomaly), "auth_credential_velocity": _t(rolling.credential_velocity), "auth_velocity_spike": _t(ranges.velocity_spike, 24),
    "auth_failure_burst": _t(ranges.failure_burst, 24), "auth_enrolment_hammering": _t(ranges.enrolment_hammering), "auth_high_risk_hours": _t(ranges.high_risk_hours, 24),
    "auth_rapid_device_switch": _t(ranges.rapid_device_switch, 24), "auth_multi_device": _t(machines.multi_device, 24), "auth_concurrent_aua": _t(ranges.concurrent_aua),
    "auth_geo_drift": _t(anchored.geo_drift), "auth_device_diversity": _t(anchored.device_diversity), "auth_model_diversity": _t(anchored.model_diversity),
    "auth_provider_switch": _t(anchored.provider_switch), "auth_aua_sa_diversity": _t(anchored.aua_sa_diversity), "auth_error_spray": _t(anchored.error_spray),
    "auth_error_hotspot": _t(anchored.error_hotspot), "auth_server_concentration": _t(anchored.server_concentration), "auth_weekend": _t(anchored.weekend),
    "auth_correlation_break": _t(rules.correlation_break), "auth_location_anchor": _t(anchored.location_anchor), "auth_fingerprint_break": _t(anchored.fingerprint_break),
    "auth_error_escalation": _t(machines.error_escalation), "auth_cert_expiry": _t(anchored.cert_expiry, 24),
    "bio_liveness_streak": _b(streaks.bio_liveness_streak), "bio_image_size_replay": _b(streaks.image_size_replay), "bio_uncanny_scores": _b(streaks.uncanny_scores, 24),
    "bio_deep_print_failures": _b(rolling.deep_print_failures), "bio_match_trend": _b(rolling.match_trend), "bio_liveness_decline": _b(rolling.liveness_decline),
    "bio_modality_concentration": _b(rolling.modality_concentration), "bio_image_size_anomaly": _b(rolling.image_size_anomaly), "bio_response_time_anomaly": _b(rolling.response_time_anomaly),
    "bio_probe_minutiae": _b(rolling.probe_minutiae), "bio_capture_spoof": _b(rules.capture_spoof), "bio_liveness_desync": _b(rules.liveness_desync), "bio_deep_print_subversion": _b(rules.deep_print_subversion),
}


def compute(name: str, events: DataFrame, state_ttl: bool = False, **parameters) -> DataFrame:
    """Alerts of one signal. With ``state_ttl``, a key without events that touch the signal's state for its time to live starts afresh."""
    signal = SIGNALS[name]
    if state_ttl and signal.ttl_hours:
        return unexpire(signal.make(with_life(events, signal.ttl_hours * 3_600_000), **parameters))
    return signal.make(events, **parameters)


#: Signals made of kernels that work on slices of a key alone.
SLICED = frozenset(
    "auth_velocity_spike auth_failure_burst auth_enrolment_hammering auth_otp_fallback auth_success_without_bio auth_location_mismatch auth_night_surge bio_deep_print_failures "
    "auth_finger_decline auth_face_decline bio_match_trend bio_liveness_decline auth_fmr_spread auth_success_cliff auth_modality_switch auth_txn_gap_avg "
    "auth_txn_gaps auth_dormancy auth_brute_force auth_cross_border auth_bot_recovery_speed auth_ghost_uptime auth_liveness_streak auth_failure_streak bio_liveness_streak "
    "auth_packet_replay bio_image_size_replay bio_uncanny_scores "
    "auth_duration_outlier auth_pid_size_anomaly bio_image_size_anomaly bio_response_time_anomaly bio_probe_minutiae "
    "auth_geo_drift auth_device_diversity auth_model_diversity auth_provider_switch auth_aua_sa_diversity auth_error_spray "
    "auth_txn_counts auth_retry_session auth_txn_oddhour_ratio auth_rd_software_change auth_biometric_replay auth_time_entropy auth_credential_velocity auth_high_risk_hours "
    "auth_rapid_device_switch auth_concurrent_aua auth_error_hotspot auth_server_concentration auth_weekend auth_cert_expiry bio_modality_concentration "
    "bio_capture_spoof bio_liveness_desync bio_deep_print_subversion".split()
)


def compute_sliced(name: str, events: DataFrame, most: int = 1_000_000, grain_ms: int = 1000, **parameters) -> DataFrame:
    """Alerts of one signal, where keys of more than ``most`` events are cut into time slices of about that many.

    Other keys take the plain windows. There are at most as many hot keys as ``most`` goes into the number of events; they are broadcast
    where a count shows that they are few.
    """
    if name not in SLICED:
        raise ValueError(f"{name} is not made of kernels that work on slices")
    make = SIGNALS[name].make
    events = events.select(KEY, TIME, TIE, *READS[name]) if name in READS else events
    hot = written(events.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(KEY))
    if hot.isEmpty():
        return make(events, **parameters)
    few = broadcast_small(hot, 100_000)
    cold = make(events.join(few, KEY, "left_anti"), **parameters)
    return cold.unionByName(make(cut_slices(events.join(few, KEY, "left_semi"), most, grain_ms), **parameters))


def placed(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Events hashed by key and sorted, kept for many signals: their windows then need no exchange and no sort of their own."""
    parts = events.repartition(partitions, KEY) if partitions else events.repartition(KEY)
    return parts.sortWithinPartitions(KEY, TIME, TIE).persist()


def compute_all(events: dict[str, DataFrame], names: Iterable[str] | None = None, **options) -> DataFrame:
    """Alerts of many signals, a bag union; ``events`` by kind, ``placed`` first if there is more than one signal."""
    chosen = [n for n in (names or SIGNALS) if SIGNALS[n].kind in events]
    return reduce(DataFrame.unionByName, [compute(n, events[SIGNALS[n].kind], **options) for n in chosen])

"""Record-by-record model of routing and alerts, to hold the set-based operators against.

Events are dicts with arrival_seq, key, patient, ok (no rule error), errors, event_ms,
processed_ms, signal, value.
"""

DUP, LATE = "duplicate_event_id", "late_event"


def route_model(events, profile, lateness_ms):
    accepted_ids, newest, out = set(), None, {}
    for e in sorted(events, key=lambda e: e["arrival_seq"]):
        errors = list(e["errors"])
        if profile == "stream":
            if e["key"] in accepted_ids:
                errors.append(DUP)
            watermark = None if newest is None else newest - lateness_ms - 1
            if not errors and watermark is not None and e["event_ms"] + lateness_ms < watermark:
                errors.append(LATE)
            ts = e["event_ms"] if e["event_ms"] > 0 else e["processed_ms"]
            newest = ts if newest is None else max(newest, ts)
        elif not errors:
            newest = e["event_ms"] if newest is None else max(newest, e["event_ms"])
            if e["key"] in accepted_ids:
                errors = [DUP]
            elif e["event_ms"] < newest - lateness_ms:
                errors = [LATE]
        if not errors:
            accepted_ids.add(e["key"])
        out[e["arrival_seq"]] = errors
    return out


def cooldown_model(hits, cooldown_ms):
    """Kept (patient, arrival_seq) of (patient, arrival_seq, event_ms) hits."""
    last, kept = {}, set()
    for patient, seq, ms in sorted(hits, key=lambda h: h[1]):
        if patient in last and ms - last[patient] < cooldown_ms:
            continue
        last[patient] = ms
        kept.add((patient, seq))
    return kept


def alert_model(events, cooldown_ms):
    state, hits = {}, []
    for e in sorted(events, key=lambda e: e["arrival_seq"]):
        values = state.setdefault(e["patient"], {})
        if e["signal"]:
            values[e["signal"]] = e["value"]
        get = lambda n: values.get(n, 0.0)  # noqa: B023, E731
        if (
            get("heart_rate") >= 110
            and get("temperature_c") >= 38
            and (get("wbc") >= 12 or get("lactate") >= 2.2)
        ):
            hits.append((e["patient"], e["arrival_seq"], e["event_ms"]))
    return cooldown_model(hits, cooldown_ms)

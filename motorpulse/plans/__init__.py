from .telemetry import alert_messages, counted_windows, enriched_messages

__all__ = ["alert_messages", "counted_windows", "enriched_messages"]

"""Writers: idempotent target-model load, report sections."""

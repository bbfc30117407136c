"""Report parameters.

Constants that the original reports hard-code are fields here, with the
original value as default.  The day, the tracked visit kind and the sender of
the reports have no default: without them a report would run on an empty or
unfiltered input.  Reports never read the clock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# --- fixed values: defaults that must equal the original reports ----------
PIPELINE_ID = "803674753"
LOST_STAGE = "1182117639"
SCHEDULED_STATUSES = ("Agendado", "Cerrado")
REMINDER_STATUSES = ("Agendado",)
CANCEL_STATUSES_REPORT = ("Cancelado", "No realizada")
CANCEL_STATUSES_DIGEST = ("Cancelado", "No realizada", "Cerrado")
DONE_STATUS = "Finalizado"
PHOTO_PROFESSIONAL = 1
PHOTO_CLIENT = 3
LIVE_STATE = 2
DEAD_STATES = (3, 5, 8)
PUBLICATION_CUTOFF = dt.date(2026, 4, 13)
OLD_YEAR = 2025
EXCLUDED_CITY_SUBSTRINGS = ("jamundi", "jamundí")
PATRIMONY_OK = ("Sin patrimonio", "Patrimonio levantado")
PATRIMONY_LIFTED = "Patrimonio levantado"
ENCUMBRANCE_DENY = ("Hipoteca + Patrimonio con hijos", "Patrimonio hijos")
FLAG_DONE = "Finalizados"
FLAG_IN_PROCESS = "En proceso"
PATRIMONY_CONTRACT = "Contrato de Corretaje con patrimonio de familia"
COURT_PIPES = ("306710579", "306725945")
CLOSED_PHASES = ("Onhold", "Asignación", "Desistido", "Desistidos", "Finalizadas",
                 "Finalizado Alianza (Silencio Adm)")
PATRIMONY_PIPES = ("302291650", "303248825", "306710579", "306725945")
FINAL_PHASES = ("Finalizados Inmobiliaria", "Finalizadas", "Sentencia Ejecutoriada")
UNFAVOURABLE = "no favorable"
NO_TEAM_LABEL = "Sin equipo"
NO_VISIT_LABEL = "Sin visita"
NO_INFO_LABEL = "Sin info"
CONFIRMED = "confirmada"
CANCELLED = "cancelada"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    as_of: dt.date
    visit_types: tuple
    visit_categories: tuple
    report_sender: str
    pipeline_id: str = PIPELINE_ID
    lost_stage: str = LOST_STAGE
    scheduled_statuses: tuple = SCHEDULED_STATUSES
    reminder_statuses: tuple = REMINDER_STATUSES
    cancel_statuses_report: tuple = CANCEL_STATUSES_REPORT
    cancel_statuses_digest: tuple = CANCEL_STATUSES_DIGEST
    done_status: str = DONE_STATUS
    photo_professional: int = PHOTO_PROFESSIONAL
    photo_client: int = PHOTO_CLIENT
    live_state: int = LIVE_STATE
    dead_states: tuple = DEAD_STATES
    publication_cutoff: dt.date = PUBLICATION_CUTOFF
    old_year: int = OLD_YEAR
    excluded_city_substrings: tuple = EXCLUDED_CITY_SUBSTRINGS
    patrimony_ok: tuple = PATRIMONY_OK
    patrimony_lifted: str = PATRIMONY_LIFTED
    encumbrance_deny: tuple = ENCUMBRANCE_DENY
    flag_done: str = FLAG_DONE
    flag_in_process: str = FLAG_IN_PROCESS
    patrimony_contract: str = PATRIMONY_CONTRACT
    court_pipes: tuple = COURT_PIPES
    closed_phases: tuple = CLOSED_PHASES
    patrimony_pipes: tuple = PATRIMONY_PIPES
    final_phases: tuple = FINAL_PHASES
    unfavourable: str = UNFAVOURABLE
    opinion_lookback_months: int = 6
    completed_lookback_days: int = 30
    cancelled_lookback_days: int = 30
    subject_lookback_days: int = 60
    future_slack_days: int = 2
    utc_offset_hours: int = -5
    no_team_label: str = NO_TEAM_LABEL
    subject_text: str = "Fotos cliente"
    portal_url: str = "https://portal.example.com"
    signature: str = "Equipo Inmobiliaria"
    lead_default_email: str = "leads@example.com"
    coordinator_email: str = "coordination@example.com"
    notice_emails: tuple = ("coordination@example.com", "operations@example.com")
    max_messages: int | None = None
    #: Reports see the visit log as it was at this time (ISO text); None: all of it.
    known_at: str | None = None
    force_weekend: bool = False
    confirmed_label: str = CONFIRMED
    cancelled_label: str = CANCELLED

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @property
    def tomorrow(self) -> dt.date:
        return self.as_of + dt.timedelta(days=1)

    @property
    def day_prefix(self) -> str:
        """The visit day: ISO timestamps of tomorrow start with it."""
        return self.tomorrow.isoformat()

    @property
    def status_day_str(self) -> str:
        """The status-log day."""
        return self.tomorrow.isoformat()

    @property
    def month_start(self) -> str:
        return self.as_of.replace(day=1).isoformat()

    @property
    def new_since(self) -> str:
        """Monday looks back 3 days (over the weekend), other days 1."""
        back = 3 if self.as_of.weekday() == 0 else 1
        return (self.as_of - dt.timedelta(days=back)).isoformat()

    @property
    def is_weekend(self) -> bool:
        return self.as_of.weekday() >= 5

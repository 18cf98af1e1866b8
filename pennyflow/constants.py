"""Fixed values. They must equal the published pipeline's for the results to agree."""

# --- event types -----------------------------------------------------------------------
ACCOUNT_CREATED = "USER_CREATED_ACCOUNT"
APP_OPENED = "USER_OPENED_APP"
ADD_CASH_STARTED = "USER_INITIATED_ADD_CASH"
FIRST_ADD_CASH_STARTED = "USER_INITIATED_FIRST_ADD_CASH"
LEFT_AT_PAYMENT_LINK = "USER_LEFT_APP_AT_PAYMENT_LINK"
RETURNED_TO_PAYMENT_LINK = "USER_RETURNED_TO_PAYMENT_LINK"
PAYMENT_SUCCEEDED = "PAYMENT_SUCCEEDED"
REFERRAL_SCREEN = "USER_ENTERED_REFERRAL_SCREEN"
VALID_REFERRAL_CODE = "USER_ENTERED_VALID_REFERRAL_CODE"
REGISTER_SUCCEEDED = "USER_PROFILE_REGISTER_SUCCEEDED"
PASSWORD_SUCCEEDED = "USER_PROFILE_PASSWORD_SUCCEEDED"
INTRO_ENTERED = "USER_ENTERED_INTRO"
SAVE_SUCCEEDED = "SAVING_PAYMENT_SUCCESSFUL"
WITHDRAWAL_CONFIRMED = "WITHDRAWAL_EVENT_CONFIRMED"
WITHDRAWAL_SETTLED = "ADMIN_SETTLED_WITHDRAWAL"
BOOST_CREATED = "BOOST_CREATED"
BOOST_REDEEMED = "BOOST_REDEEMED"
BOOST_EXPIRED = "BOOST_EXPIRED"
MESSAGE_SENT = "MESSAGE_SENT"

# --- sources, money, time --------------------------------------------------------------
APP_SOURCE = "AMPLITUDE"
SERVICE_SOURCE = "INTERNAL_SERVICES"
SAVING = "SAVING_EVENT"
WITHDRAWAL = "WITHDRAWAL"
HUNDREDTH_CENT = "HUNDREDTH_CENT"
UNITS_PER_CURRENCY = {"WHOLE_CURRENCY": 1, "WHOLE_CENT": 100, "HUNDREDTH_CENT": 10_000}
SECOND_MS = 1_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000
# Named as milliseconds upstream but counted in seconds (1900-01-01); only "before all data" matters.
NEVER_FLAGGED = -2_208_988_800

# --- fraud rules -----------------------------------------------------------------------
VERY_LARGE_SAVE = 100_000
LARGE_SAVE = 50_000
AVERAGE_MULTIPLIER = 10
TOLERANCE = 0.95
ACCURACY_PENDING = "PENDING_CONFIRMATION"
RULE_VERY_LARGE = "single_very_large_saving_event"
RULE_SEVERAL_LARGE = "saving_events_greater_than_benchmark_within_six_months"
RULE_ABOVE_AVERAGE = "latest_saving_event_greater_than_six_months_average"
RULE_TWO_DAYS = "withdrawals_within_two_days_of_saving_events_during_one_month"
RULE_ONE_DAY = "withdrawals_within_one_day_of_saving_events_during_one_week"
RULE_LABELS = (RULE_VERY_LARGE, RULE_SEVERAL_LARGE, RULE_ABOVE_AVERAGE, RULE_TWO_DAYS, RULE_ONE_DAY)
NOT_FLAGGED = "user_not_flagged"

# --- offers ----------------------------------------------------------------------------
SAVE_CONDITIONS = (
    "save_greater_than",
    "first_save_above",
    "balance_crossed_major_digit",
    "balance_crossed_abs_target",
)
OFFER_CATEGORIES = (
    "GAME::CHASE_ARROW",
    "GAME::DESTROY_IMAGE",
    "GAME::TAP_SCREEN",
    "SIMPLE::ROUND_UP",
    "SIMPLE::SIMPLE_SAVE",
    "SIMPLE::TIME_LIMITED",
    "SIMPLE::TARGET_BALANCE",
    "SOCIAL::FRIENDS_ADDED",
    "SOCIAL::NUMBER_FRIENDS",
    "WITHDRAWAL::CANCEL_WITHDRAWAL",
)

# --- funnels: (step, next step) --------------------------------------------------------
SAVING_STAGES = (
    (FIRST_ADD_CASH_STARTED, LEFT_AT_PAYMENT_LINK),
    (ADD_CASH_STARTED, LEFT_AT_PAYMENT_LINK),
    (LEFT_AT_PAYMENT_LINK, RETURNED_TO_PAYMENT_LINK),
    (RETURNED_TO_PAYMENT_LINK, PAYMENT_SUCCEEDED),
)
ONBOARDING_STAGES = (
    (REFERRAL_SCREEN, VALID_REFERRAL_CODE),
    (VALID_REFERRAL_CODE, REGISTER_SUCCEEDED),
    (REGISTER_SUCCEEDED, PASSWORD_SUCCEEDED),
    (PASSWORD_SUCCEEDED, FIRST_ADD_CASH_STARTED),
)
DEFAULT_FUNNEL = (
    ("ENTERED_ONBOARD_SCREEN", ("ENTERED_REFERRAL_CODE", "USER_LOGGED_IN")),
    ("ENTERED_REFERRAL_CODE", ("USER_LOGGED_IN",)),
)

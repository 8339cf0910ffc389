"""Labels, bounds and lookup tables that results must carry exactly.

Everything in this module is a fixed value. A band is a list of
``(label, bound)`` read top to bottom; the last bound is ``None`` and takes
whatever is left.
"""

from __future__ import annotations

# Label and exclusive upper bound.
PACE_ZONES = [
    ("elite", 4.0),
    ("fast", 5.0),
    ("moderate", 6.0),
    ("easy", 7.0),
    ("recovery", None),
]
HR_ZONES = [
    ("zone_1_recovery", 120),
    ("zone_2_base", 140),
    ("zone_3_tempo", 160),
    ("zone_4_threshold", 175),
    ("zone_5_max", None),
]
TERRAINS = [("flat", 50), ("rolling", 150), ("hilly", 300), ("mountainous", None)]
SLEEP_QUALITIES = [("poor", 5.0), ("fair", 6.0), ("good", 7.0), ("excellent", None)]

# Training-load factor and exclusive upper heart-rate bound.
LOAD_FACTORS = [(1.0, 130), (1.5, 150), (2.0, 170), (2.5, None)]
LOAD_FACTOR_NO_HR = 1.0

# Label and inclusive upper bound.
STRESS_LEVELS = [("low", 25), ("moderate", 50), ("high", 75), ("very_high", None)]

# Label and inclusive lower bound.
BATTERY_LEVELS = [("high", 75), ("moderate", 50), ("low", 25), ("depleted", None)]
HRV_LEVELS = [("excellent", 60), ("good", 40), ("moderate", 20), ("low", None)]
READINESS_LEVELS = [("high", 70), ("moderate", 40), ("low", None)]

# Points of the daily recovery score (0-100), then the neutral
# points given when the reading is missing.
DAY_SCORE_SLEEP = [(35, 8.0), (30, 7.0), (20, 6.0), (10, 5.0), (0, None)]  # hours >=
DAY_SCORE_STRESS = [(25, 25), (15, 50), (5, 75), (0, None)]  # <=
DAY_SCORE_BATTERY = [(25, 75), (18, 50), (8, 25), (0, None)]  # >=
DAY_SCORE_RHR = [(15, 45), (12, 55), (8, 65), (4, 75), (0, None)]  # <
DAY_SCORE_NEUTRAL = {"stress": 12, "battery": 12, "rhr": 7}

# Points of the trend recovery score. Sleep gives up to 40.
TREND_SLEEP_POINTS = 40
TREND_SLEEP_TARGET_HOURS = 8.0
TREND_RHR = [(20, 1.0), (15, 1.05), (10, 1.10), (5, None)]  # <= mean x factor
TREND_STRESS = [(20, 25), (15, 40), (10, 55), (5, None)]  # <=
TREND_BATTERY = [(20, 20), (15, 10), (10, 0), (5, None)]  # >=
TREND_NEUTRAL = 10

# Race distance and its closed range in km; beyond the last is Ultra.
DISTANCE_BANDS = [
    ("5K", 4.8, 5.2),
    ("10K", 9.8, 10.3),
    ("Half Marathon", 20.9, 21.4),
    ("Marathon", 41.9, 43.0),
]
ULTRA_LABEL = "Ultra"
ULTRA_ABOVE_KM = 43.0
DISTANCE_LABELS = ["5K", "10K", "Half Marathon", "Marathon", "Ultra"]

# Words in an activity name that mark a race.
RACE_WORDS = ["race", "marathon", "5k", "10k", "half", "semi-marathon", "trail"]

# Months of each season.
SEASON_MONTHS = {
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
    "Winter": [12, 1, 2],
}

# Weekday names, Sunday = 0.
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Accepted pace range in min/km; anything else is a device fault.
PACE_MIN, PACE_MAX = 2.0, 20.0
MIN_DURATION_MINUTES = 5
STEPS_GOAL = 10000

# The weather fields of an activity.
WEATHER_FIELDS = [
    "weather_temp_c",
    "weather_feels_like_c",
    "weather_humidity_pct",
    "weather_wind_speed_ms",
    "weather_condition",
    "weather_precipitation_mm",
]

# Weather code to label.
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Icy fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Heavy drizzle",
    61: "Light rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Light snow",
    73: "Moderate snow",
    75: "Heavy snow",
    77: "Snow grains",
    80: "Light showers",
    81: "Moderate showers",
    82: "Heavy showers",
    85: "Light snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with hail",
    99: "Thunderstorm with heavy hail",
}

# Label and the words that select it, first match wins.
WEATHER_GROUPS = [
    ("☀️ Clear", ["sunny", "clear"]),
    ("☁️ Cloudy", ["cloud", "overcast"]),
    ("🌧️ Rain", ["rain", "drizzle"]),
    ("❄️ Snow", ["snow", "sleet"]),
    ("💨 Windy", ["wind", "gust"]),
    ("🌫️ Foggy", ["fog", "mist"]),
    ("⛈️ Storm", ["thunder", "storm"]),
]

# Activity type to display label; others show "⚡" and their own name.
ACTIVITY_LABELS = {
    "running": "🏃 Running",
    "trail_running": "🏔️ Trail Running",
    "treadmill": "🏃 Treadmill",
    "cycling": "🚴 Cycling",
    "swimming": "🏊 Swimming",
    "walking": "🚶 Walking",
    "hiking": "🥾 Hiking",
    "strength": "💪 Strength",
    "yoga": "🧘 Yoga",
    "other": "⚡ Other",
}
ACTIVITY_LABEL_OTHER = "⚡ "

# Readiness to display label and advice; unknown reads as moderate.
READINESS_CARDS = {
    "optimal": ("✅ Optimal", "You're well recovered. Great day for a quality session."),
    "good": ("👍 Good", "Good readiness. Normal training recommended."),
    "moderate": ("⚠️ Moderate", "Moderate recovery. Keep intensity in check today."),
    "low": ("🔴 Low", "Poor recovery. Consider rest or easy activity only."),
}
READINESS_DEFAULT = "moderate"
READINESS_ORDER = ["optimal", "good", "moderate", "low"]

# Zones by share of maximum heart rate, [from, to).
HR_RATIO_ZONES = [
    ("Zone 1 - Recovery", 0.50, 0.60),
    ("Zone 2 - Aerobic", 0.60, 0.70),
    ("Zone 3 - Tempo", 0.70, 0.80),
    ("Zone 4 - Threshold", 0.80, 0.90),
    ("Zone 5 - VO2max", 0.90, 1.00),
]

# Goal distance to km; others count as a half marathon.
GOAL_KM = {"5K": 5.0, "10K": 10.0, "Half Marathon": 21.0975, "Marathon": 42.195}
GOAL_KM_DEFAULT = 21.0975

# Race-goal outcome and the inclusive factor of the goal time.
GOAL_NONE = "No goal set"
GOAL_BANDS = [
    ("Goal achieved ✅", 1.0),
    ("Just missed (<2%)", 1.02),
    ("Close (2–5%)", 1.05),
    ("Missed goal (>5%)", None),
]
GOAL_ACHIEVED = "Goal achieved ✅"
GOAL_JUST_MISSED = "Just missed (<2%)"

# Race rating and inclusive upper bound of % off the record.
RATINGS = [("Near PR", 5), ("Good", 10), ("Fair", 20), ("Off Day", None)]
RATING_PR = "PR"

# Race pace minus training pace, min/km.
PACING_LABELS = [
    "Much faster than training",
    "Faster than training",
    "Consistent with training",
    "Slower than training",
    "No training data",
]
RECOVERY_LABELS = ["First race", "Quick turnaround", "Standard recovery", "Well rested"]

# Race readiness score, its 30-day km and least days since the last race.
RACE_READINESS = [(9, 100, 14), (8, 80, 10), (7, 60, None), (6, 40, None)]
RACE_READINESS_BASE = 5

# Temperature bucket and its range in deg C, [from, to).
TEMP_BUCKETS = [
    ("Cold (< 5°C)", None, 5),
    ("Cool (5–15°C)", 5, 15),
    ("Mild (15–22°C)", 15, 22),
    ("Warm (> 22°C)", 22, None),
]

# Level, emoji and text of each alert, the graver one first.
ALERT_TEXTS = {
    "load": [
        (
            "red",
            "🔴",
            "Training load spike: ACWR is {acwr} (>1.5 = high injury risk). "
            "Acute load is {acwr_pct}% of your chronic baseline.",
        ),
        (
            "yellow",
            "🟡",
            "Training load increasing quickly: ACWR is {acwr} (optimal range: 0.8–1.3). "
            "Monitor for fatigue signs.",
        ),
    ],
    "hrv": [
        (
            "red",
            "🔴",
            "HRV dropped {drop}% vs your 4-week average (now {hrv}ms). "
            "Strong recovery signal — consider an easy week.",
        ),
        (
            "yellow",
            "🟡",
            "HRV trending down: {trend}% vs 4-week average ({hrv}ms). Mild fatigue accumulation.",
        ),
    ],
    "sleep": [
        (
            "red",
            "🔴",
            "Critical sleep deficit: averaging {hours}h/night this week "
            "(minimum recommended for athletes: 7h). Performance will be impaired.",
        ),
        (
            "yellow",
            "🟡",
            "Insufficient sleep: {hours}h/night average this week. "
            "Athletes typically need 7–9h for optimal recovery.",
        ),
    ],
    "recovery": [
        (
            "red",
            "🔴",
            "Low recovery score: {score}/100 average this week. "
            "Body is not fully recovering between sessions.",
        ),
    ],
    "goal_gap": [
        (
            "yellow",
            "🎯",
            "Ambitious goal: your current {distance} pace is {now}/km — your target requires "
            "{goal}/km ({gap}% faster). Worth discussing with your coach.",
        ),
    ],
}
# Limits of the alerts, in the order of the texts above.
ACWR_LIMITS = [1.5, 1.3]  # above
HRV_TREND_LIMITS = [-20, -10]  # below
SLEEP_LIMITS = [5.0, 6.5]  # below
RECOVERY_LIMIT = 40  # below
GOAL_GAP_LIMIT = -25  # below

# The lines of the coaching text.
PROMPT_LINES = [
    "ATHLETE DATA — last 4 weeks",
    "",
    "TRAINING LOAD",
    "- Weekly volume: {weekly_km} km/week (4-week avg)",
    "- Training load (TRIMP): {weekly_load}/week (4-week avg)",
    "- Load trend: {load_trend}% vs previous 4 weeks",
    "- ACWR (injury risk ratio): {acwr} (optimal: 0.8–1.3 | caution: >1.3 | danger: >1.5)",
    "- Average pace: {pace}/km",
    "- HR zone split: {easy}% easy (zones 1–2) / {hard}% hard (zones 3–5)",
    "  Note: 80/20 rule = ~80% easy / 20% hard",
    "",
    "HEALTH — last 7 days",
    "- Sleep: {sleep}h/night avg",
    "- HRV: {hrv} (trend vs 4-week avg: {hrv_trend})",
    "- Resting HR: {resting_hr}",
    "- Stress: {stress}",
    "- Recovery score: {recovery}",
    "- Training readiness: {readiness}",
    "",
    "RACE HISTORY",
    "- Last race: {last_distance} at {last_pace}/km",
    "- PRs: 5K {pr_5k} | 10K {pr_10k} | Half {pr_half} | Marathon {pr_marathon}",
    "",
    "GOAL",
    "- Race: {goal}",
    "- Target time: {goal_hours}h{goal_minutes}",
    "- Required pace: {goal_pace}/km",
    "- Time to race: {weeks} weeks",
]
NOT_KNOWN = "N/A"

# The lines of the weather texts.
WEATHER_HEAD = "Historical weather impact (based on {n} runs with weather data):"
WEATHER_TEMP_HEAD = "Temperature vs pace:"
WEATHER_BUCKET = "  {bucket}: avg pace {pace}/km ({n} runs)"
WEATHER_WIND = (
    "Wind impact: pace is {size}s/km {direction} in strong wind (>25 km/h)"
    " vs calm conditions (<15 km/h)"
)
WEATHER_RAIN = "Rain impact: pace is {size}s/km {direction} in rainy conditions (≥2mm) vs dry runs"
FORECAST_HEAD = "WEATHER FORECAST — {city} (next 7 days)"
FORECAST_DAY = "- {day} ({date}): {low}–{high}°C, {condition}{flags}"
FORECAST_HEAT = "⚠️ heat"
FORECAST_FROST = "⚠️ frost"

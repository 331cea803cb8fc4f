"""Class lists, codes, column names and tuned parameters.

Everything here has to equal the published contest data dictionary or the published model
settings for results to agree, so it is stated plainly and kept in one place.
"""

# --- fixed values: class vocabularies -------------------------------------------------
BALLS = ["straight", "curve", "slider", "shoot", "fork", "changeup", "sinker", "cutball"]
ZONES = [f"course_{n}" for n in range(13)]

# ten overlapping groups of zones
ZONE_GROUPS = {
    "high_str": [0, 3, 6],
    "high_ball": [9, 10],
    "mid_str": [1, 4, 7],
    "low_str": [2, 5, 8],
    "low_ball": [11, 12],
    "left_str": [0, 1, 2],
    "left_ball": [9, 11],
    "center_str": [3, 4, 5],
    "right_str": [6, 7, 8],
    "right_ball": [10, 12],
}

# --- fixed values: 13 zones coarsened, position = zone, value = coarse class ------------
LR_LOOKUP = [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 4, 3, 4]
LR_CLASSES = ["left_str", "center_str", "right_str", "left_ball", "right_ball"]
HL_LOOKUP = [0, 1, 2, 0, 1, 2, 0, 1, 2, 3, 3, 4, 4]
HL_CLASSES = ["high_str", "mid_str", "low_str", "high_ball", "low_ball"]
STRIKE_LOOKUP = [0] * 9 + [1] * 4
STRIKE_CLASSES = ["strike", "ball"]

# --- fixed values: codes found in the data ----------------------------------------------
HAND_CODES = {"左": "L", "右": "R"}
HANDS = ["R_L", "R_R", "L_L", "L_R"]
THROW_HANDS = [("右", "R_L"), ("右", "R_R"), ("左", "L_L"), ("左", "L_R")]
BAT_HANDS = [("左", "R_L"), ("右", "R_R"), ("左", "L_L"), ("右", "L_R")]
BOTTOM_HALF = "裏"
STARTER = "先発"
PITCHER = "投手"
CATCHER = "捕手"
DOMESTIC = "日本"
INTERLEAGUE = "セ・パ交流戦"
CENTRAL_LEAGUE = "セ・リーグ公式戦"
UNDRAFTED_YEARS = 6

# --- fixed values: last row number of each fold, for 4, 5 and 3 folds ---------------------
EDGES_4 = [60860, 120081, 180856, 257116]
EDGES_5 = [51506, 100844, 150063, 200447, 257116]
EDGES_3 = [80792, 160391, 257116]

# --- fixed values: event columns, source name -> (name here, type) -------------------------
EVENT_COLUMNS = {
    "データ内連番": ("row_no", "bigint"),
    "球種": ("ball", "int"),
    "投球位置区域": ("course", "int"),
    "年度": ("year", "int"),
    "試合内連番": ("no_in_game", "int"),
    "試合ID": ("game_id", "bigint"),
    "日付": ("game_date", "string"),
    "時刻": ("game_time", "string"),
    "ホームチームID": ("home_team_id", "bigint"),
    "アウェイチームID": ("away_team_id", "bigint"),
    "球場ID": ("stadium_id", "bigint"),
    "球場名": ("stadium_name", "string"),
    "試合種別詳細": ("game_type", "string"),
    "試合内投球数": ("pitch_cnt_in_game", "int"),
    "イニング": ("inning", "int"),
    "表裏": ("half", "string"),
    "イニング内打席数": ("bat_cnt_in_inning", "int"),
    "打席内投球数": ("pitch_cnt_in_bat", "int"),
    "投手ID": ("pitcher_id", "bigint"),
    "投手チームID": ("pitcher_team_id", "bigint"),
    "投手投球左右": ("pitcher_hand", "string"),
    "投手役割": ("pitcher_role", "string"),
    "投手登板順": ("pitch_order", "int"),
    "投手試合内対戦打者数": ("player_cnt_in_game", "int"),
    "投手試合内投球数": ("pitcher_cnt_in_game", "int"),
    "投手イニング内投球数": ("pitcher_cnt_in_inning", "int"),
    "打者ID": ("batter_id", "bigint"),
    "打者チームID": ("batter_team_id", "bigint"),
    "打者打席左右": ("batter_side", "string"),
    "打者打順": ("bat_order", "int"),
    "打者守備位置": ("batter_position", "string"),
    "打者試合内打席数": ("bat_cnt_in_game", "int"),
    "プレイ前ホームチーム得点数": ("home_point", "int"),
    "プレイ前アウェイチーム得点数": ("away_point", "int"),
    "プレイ前アウト数": ("out_cnt", "int"),
    "プレイ前ボール数": ("ball_cnt", "int"),
    "プレイ前ストライク数": ("strike_cnt", "int"),
    "プレイ前走者状況": ("runner_state", "string"),
    "一塁走者ID": ("runner1_id", "double"),
    "二塁走者ID": ("runner2_id", "double"),
    "三塁走者ID": ("runner3_id", "double"),
    "捕手ID": ("catcher_id", "bigint"),
    "一塁手ID": ("fielder_1b_id", "bigint"),
    "二塁手ID": ("fielder_2b_id", "bigint"),
    "三塁手ID": ("fielder_3b_id", "bigint"),
    "遊撃手ID": ("fielder_ss_id", "bigint"),
    "左翼手ID": ("fielder_lf_id", "bigint"),
    "中堅手ID": ("fielder_cf_id", "bigint"),
    "右翼手ID": ("fielder_rf_id", "bigint"),
    "成績対象投手ID": ("charged_pitcher_id", "bigint"),
    "成績対象打者ID": ("charged_batter_id", "bigint"),
}
LABELS = ["ball", "course"]

# --- fixed values: actor columns, source name -> (name here, type) --------------------------
ACTOR_COLUMNS = {
    "年度": ("year", "int"),
    "選手ID": ("player_id", "bigint"),
    "位置": ("position", "string"),
    "チームID": ("team_id", "bigint"),
    "チーム名": ("team_name", "string"),
    "選手名": ("player_name", "string"),
    "背番号": ("uniform_no", "string"),
    "育成選手F": ("firm", "string"),
    "生年月日": ("birth_date", "string"),
    "身長": ("height", "double"),
    "体重": ("weight", "double"),
    "出身高校ID": ("highschool_id", "bigint"),
    "出身高校名": ("highschool_name", "string"),
    "出身大学ID": ("univ_id", "bigint"),
    "出身大学名": ("univ_name", "string"),
    "社会人": ("company", "string"),
    "ドラフト年": ("draft_year", "double"),
    "ドラフト種別": ("draft_kind", "string"),
    "ドラフト順位": ("draft_order", "double"),
    "年俸": ("salary", "double"),
    "投": ("throws", "string"),
    "打": ("bats", "string"),
    "出身国": ("country", "string"),
    "出身地": ("birthplace", "string"),
    "血液型": ("blood_type", "string"),
}

# --- fixed values: raw counters that stay in the wide table -----------------------------------
COUNTERS = [
    "pitch_cnt_in_game", "inning", "bat_cnt_in_inning", "pitch_cnt_in_bat", "pitch_order",
    "player_cnt_in_game", "pitcher_cnt_in_game", "pitcher_cnt_in_inning", "bat_order",
    "bat_cnt_in_game", "home_point", "away_point", "out_cnt", "ball_cnt", "strike_cnt",
]

# --- fixed values: profile columns of one actor, and those subtracted between roles -------------
PROFILE = [
    "height", "weight", "draft_order", "salary", "age", "play_year", "salary_rank",
    "rank_year", "rank_x_year", "salary_year", "salary_x_year", "bmi",
]
PROFILE_DIFFS = [
    "salary", "play_year", "age", "salary_year", "salary_x_year", "rank_year", "rank_x_year",
    "bmi",
]

# --- fixed values: counters kept per role ------------------------------------------------------
ROLE_COUNTERS = {
    "pitcher": ["pit_game_cnt", "pit_inning_cnt", "pit_batter_cnt"],
    "catcher": ["cat_game_cnt"],
    "batter": ["batter_cnt", "bat_game_cnt"],
}
ROLE_SUFFIX = {"pitcher": "_pit", "batter": "_bat", "catcher": "_cat"}

# --- fixed values: source pairs of the combination features, name -> (left, right) ----------------
ROLE_PAIRS = {"p_b": ("pit", "bat"), "p_c": ("pit", "cat"), "b_c": ("bat", "cat")}
MIX_PAIRS = {
    "bc_p": ("bc", "pit"), "p_c": ("pit", "cat"), "bc_c": ("bc", "cat"),
    "p_b": ("pit", "bat"), "bc_b": ("bc", "bat"), "b_c": ("bat", "cat"),
}

# --- fixed values: tuned booster parameters (task, variant) -----------------------------------------
TUNED = {
    ("ball", "gbdt"): dict(learning_rate=0.1, num_leaves=18, feature_fraction=0.45199999999999996,
                           bagging_fraction=0.9799724836460725, min_child_samples=20,
                           rounds=10000),
    ("ball", "dart"): dict(learning_rate=0.1, num_leaves=39, feature_fraction=0.552,
                           bagging_fraction=1.0, min_child_samples=50, rounds=800),
    ("course", "gbdt"): dict(learning_rate=0.1, num_leaves=6, feature_fraction=0.4,
                             bagging_fraction=0.8391111798378441, min_child_samples=50,
                             rounds=10000),
    ("course", "dart"): dict(learning_rate=0.1, num_leaves=6, feature_fraction=0.516,
                             bagging_fraction=0.7965160701163017, min_child_samples=20,
                             rounds=2300),
}
EARLY_STOP = 100

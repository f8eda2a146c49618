"""Published record-level scores of one final sample, as test input."""

# Age, state, outcome and score of 160 rows, in published order.
ROWS = """
59 FL 0 0.001870459025705074
53 NJ 1 0.04719370277696212
61 NJ 0 0.017440427457501875
38 IL 0 0.0021865192096358664
27 NY 0 0.27012036017743746
39 TX 0 0.004706601399939855
43 NJ 0 0.007017063089038277
43 NC 0 0.002157709723517489
57 FL 0 0.0009281385847973113
37 NJ 0 0.003832246336739955
47 OH 0 0.0024568155722068715
29 NC 0 0.011036595058861056
48 CA 0 0.03724709477637785
42 GA 0 0.004046920807468638
32 CA 0 0.008909825433498683
39 CA 0 0.31169213604135626
40 CA 0 0.008738889705565592
38 NY 1 0.014435862406281589
65 MA 0 0.009810701531692773
41 FL 0 0.004851980462315977
39 OH 0 0.00511307374148063
19 NJ 0 0.0003421018530260552
30 NY 0 0.011562589674444415
39 CA 0 0.0013813126887495784
33 NY 0 0.0008783305383394488
60 GA 0 0.009007423134824246
40 MA 0 0.028037457316594856
59 VA 0 0.040866319996965286
43 VA 0 0.001405160482080494
42 NJ 0 0.027104669197682518
41 NY 0 0.03891871287165713
42 TX 0 0.007748076976770351
64 NC 0 0.014582819457552727
19 CA 0 0.0038008378571281424
19 PA 0 0.002465240206837386
35 IL 1 0.10227447655065874
42 NJ 0 0.00940714946946098
51 FL 0 0.005193335158850051
48 PA 0 0.06646917232153543
37 FL 0 0.005261457397289749
55 TX 0 0.010500156049019924
55 OH 0 0.014260576377121397
44 MA 0 0.013975259752767257
55 PA 0 0.0658820032549439
46 VA 0 0.0020272505819164785
35 VA 0 0.0015692382074647417
51 IL 0 0.0026755866856761528
43 OH 0 0.006121909973341219
42 NC 0 0.0039240344474105035
61 NJ 0 0.016146856750648243
19 CA 0 0.005518516770221668
24 CA 0 0.011417814425359036
27 FL 0 0.00971375961070734
37 GA 0 0.08048427613782229
39 IL 0 0.005530532529242825
22 CA 0 0.024600852216283105
29 GA 0 0.003489719193295363
31 MA 0 0.009770980050926659
74 CA 0 0.008447581525343485
65 OH 0 0.02595586889865995
37 CA 1 0.043890028582649274
37 FL 0 0.007578425845152686
27 TX 0 0.0016201013009175197
19 OH 0 0.0034418249403726344
40 CA 0 0.008566264694390029
29 CA 0 0.027559175210919152
41 IL 0 0.008852660779331094
21 OH 0 0.043902654159803184
32 NY 0 0.003222816382419802
44 NJ 0 0.0007997719385564486
47 GA 0 0.0010447920232088547
47 VA 0 0.0029738042907715705
25 CA 0 0.03462614249538513
53 CA 0 0.04918981922412599
32 TX 0 0.005213173104401985
50 MA 0 0.005070799955710146
42 FL 0 0.01045747314431453
24 VA 0 0.016565671677822177
38 PA 0 0.10687102376249126
47 NC 0 0.01570671640894758
50 PA 0 0.0025909988068224528
40 OH 0 0.0003368136096371678
62 PA 0 0.014518444866227873
55 NY 0 0.02352735448020386
39 NY 0 0.0010032919972676124
52 NJ 0 0.003642632683501993
67 TX 0 0.0015104369526414067
67 IL 0 0.020427534432701892
26 OH 0 0.0011940744317945333
30 FL 0 0.0014688217179190904
61 FL 0 0.05073220216033026
28 CA 0 0.013865285413203627
25 NC 0 0.0014006870615477342
36 NY 0 0.001775149492417524
47 CA 1 0.028201771599750156
41 NY 0 0.022018307876580833
34 NJ 0 0.015113118809234693
33 FL 0 0.14692180472425234
33 NY 0 0.03350010744910538
31 NY 0 0.05084482474178344
72 NC 0 0.018807062775414864
46 NY 0 0.02716294436086774
54 IL 0 0.027818397130251672
36 CA 0 0.0019425766079206302
40 OH 0 0.009752367319045508
33 MA 0 0.00016498346880363516
19 PA 0 0.016132386015309825
24 OH 0 0.0016717329903619398
19 TX 0 0.008358025198143016
19 CA 0 0.0036274656218072644
26 MA 0 0.04030408747289772
59 MA 0 0.007778291321418856
41 CA 0 0.008589779088513922
59 CA 0 0.020948175881919138
47 NY 0 0.006777002960911881
52 FL 1 0.07854626537595491
30 GA 0 0.0038563745439609116
49 TX 0 0.015392682005914697
51 GA 0 0.013353700878830428
35 NY 0 0.013944593381762595
49 VA 0 0.003344579526361635
49 OH 0 0.01121754851270772
35 MA 0 0.002171566933612399
27 NY 0 0.07308299097155903
27 CA 0 0.005786482315108394
43 PA 1 0.057704551095228734
46 IL 0 0.013490905289558507
32 GA 0 0.0026671733823328005
42 CA 1 0.019929035976658134
49 NY 0 0.10316815469530465
50 CA 0 0.030704921581915616
62 FL 0 0.019970575322201898
59 FL 0 0.033623375603808764
29 NJ 0 0.009099172375689163
64 VA 0 0.002334428336363963
35 PA 0 0.012532771759389931
56 IL 0 0.0014146948200524782
43 TX 0 0.003521807591469038
37 NY 0 0.016052563861421103
19 IL 0 0.010403383898048475
40 MA 0 0.0034252345293528928
22 TX 0 0.02484241848224854
55 VA 0 0.01439801401909274
62 FL 1 0.04721923784557586
32 CA 0 0.0067468072086652835
46 GA 0 0.0037467786197569086
33 GA 0 0.00014272429950080921
34 NY 0 0.000980590402242925
52 GA 0 0.002831552053778675
41 VA 0 0.017276242232379967
65 NY 0 0.013760141921356703
36 FL 0 0.014245932602422262
55 PA 0 0.07115481159262303
43 FL 0 0.001285976446036886
52 OH 0 0.002910707959533079
36 CA 0 0.01318494555433358
41 FL 0 0.00820597816600043
40 NJ 0 0.011437348294093095
31 FL 0 0.009901399602686285
51 NC 0 0.011210408015078503
"""

THRESHOLD = 0.027981534899486266


def golden_rows() -> list[tuple[int, int, str, int, float]]:
    out = []
    for i, line in enumerate(ROWS.strip().splitlines()):
        age, state, outcome, score = line.split()
        out.append((i, int(age), state, int(outcome), float(score)))
    return out
